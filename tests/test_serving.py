from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from collected import rows
from tillhouse.functions.exprs import contains_text, range_days, range_months
from tillhouse.plans import ops, serving

D = dt.date
SALES = "period_date date, category string, total_gmv decimal(22,2), total_orders bigint, returned_orders bigint"
ALERTS = "product_id string, product_name string, category string, alert_level string, days_of_stock_remaining decimal(10,1), snapshot_date date"
COHORTS = "cohort_week date, weeks_since_acquisition int, customers_in_cohort bigint, active_customers bigint, retention_rate decimal(10,4)"
RETURNS = "period_date date, year int, month int, product_id string, product_name string, category string, total_orders bigint, returned_orders bigint, return_rate double, return_rate_change double"


@pytest.fixture
def sales(frame):
    m = Decimal
    return frame(SALES, (D(2024, 1, 31), "a", m("10.00"), 2, 1), (D(2024, 1, 31), None, m("20.00"), 1, 0), (D(2024, 1, 1), "a", m("5.00"), 1, 1), (D(2023, 12, 31), "b", m("99.00"), 1, 0))


@pytest.fixture
def alerts(frame):
    day = D(2024, 1, 31)
    d = lambda x: None if x is None else Decimal(x)
    return frame(
        ALERTS, ("p1", "Red Lamp", "a", "green", d("1"), day), ("p2", "lamp 50%_off", "a", "red", None, day), ("p3", "Chair", "b", "red", d("9"), day),
        ("p4", "Lamp", "b", "yellow", d("2"), D(2024, 1, 30)), ("p5", "Sofa", "b", "red", d("3"), day),
    )


def test_daily_trend(sales):
    as_of = serving.latest(sales, "period_date")
    got = serving.daily_sales_trend(sales, 30, as_of).collect()
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [(D(2024, 1, 1), Decimal("5.00"), 1, 5.0), (D(2024, 1, 31), Decimal("30.00"), 3, 10.0)]


def test_categories(sales):
    got = serving.sales_by_category(sales, 30, as_of=serving.latest(sales, "period_date")).collect()
    assert [(r["category"], r["total_gmv"]) for r in got] == [("Unknown", Decimal("20.00")), ("a", Decimal("15.00"))]
    assert got[1]["return_rate"] == pytest.approx(2 / 3)
    assert serving.sales_by_category(sales, 60, top=1, as_of=serving.latest(sales, "period_date")).first()["category"] == "b"


def test_home_kpis(sales, alerts):
    got = serving.home_kpis(sales, alerts).first()
    assert (got["today_gmv"], got["today_orders"], got["today_aov"], got["active_sku_alerts"]) == (Decimal("30.00"), 3, 10.0, 3)
    none = serving.home_kpis(sales.where("false"), alerts.where("false")).first()
    assert (none["today_gmv"], none["today_orders"], none["today_aov"], none["active_sku_alerts"]) == (0, 0, 0.0, 0)


def test_alert_filters(alerts):
    names = lambda **kw: [r["product_id"] for r in serving.inventory_alerts_filtered(alerts, **kw).collect()]
    assert names() == ["p5", "p3", "p2", "p4", "p1"]
    assert names(descending=True) == ["p1", "p4", "p2", "p3", "p5"]
    assert names(level="red", category="b") == ["p5", "p3"]
    assert names(search=" LAMP ") == ["p2", "p4", "p1"]
    assert names(search="50%_") == ["p2"] and names(search="%") == ["p2"] and names(search="_o") == ["p2"]
    assert names(sort_by="days_of_stock_remaining") == ["p1", "p4", "p5", "p3", "p2"]
    assert names(sort_by="product_name", descending=True)[0] == "p2"
    assert serving.inventory_stats(alerts).first()[:] == (5, 3, 1, 1)


def test_cohort_views(frame):
    weeks = [D(2024, 1, 1) + dt.timedelta(weeks=w) for w in range(14)]
    given = [(w, 0, 10, 5, Decimal("0.5000")) for w in weeks] + [(weeks[13], 12, 10, 1, Decimal("0.1000")), (weeks[13], 13, 10, 1, Decimal("0.0900"))]
    cohorts = frame(COHORTS, *given)
    table = serving.cohort_table(cohorts).collect()
    assert len(table) == 15 and (table[0][0], table[1][1]) == (weeks[13], 12)
    heat = serving.cohort_heatmap(cohorts).collect()
    assert [r[0] for r in heat] == list(reversed(weeks[2:]))
    assert (heat[0]["week_0"], heat[0]["week_12"], heat[1]["week_12"]) == (Decimal("0.5000"), Decimal("0.1000"), None)
    assert rows(serving.cohort_bands(cohorts)) == [("strong", 14), ("weak", 1)]


@pytest.mark.parametrize(("rate", "band"), [(0.4, "strong"), (0.3999, "fair"), (0.2, "fair"), (0.1, "weak"), (0.0999, "poor")])
def test_bands(frame, rate, band):
    assert frame("r double", (rate,)).select(serving.retention_band(F.col("r"))).first()[0] == band


def test_customer_summary(frame):
    df = frame("tier string, total_spent decimal(12,2)", ("gold", Decimal("10.00")), ("silver", None), (None, Decimal("2.00")))
    assert serving.customer_tier_summary(df).first()[:] == (3, 4.0, 0, 1, 1)
    assert serving.customer_tier_summary(df.where("false")).first()[:2] == (0, 0.0)


def test_returns(frame):
    row = lambda d, p, n, k, r, c=None, cat="x": (d, d.year, d.month, p, p, cat, n, k, r, c)
    returns = frame(
        RETURNS, row(D(2024, 6, 1), "b", 4, 2, 0.5, 0.1), row(D(2024, 6, 1), "a", 2, 1, 0.5, None, None), row(D(2024, 6, 1), "c", 1, 0, 0.0),
        row(D(2024, 1, 1), "a", 10, 5, 0.5), row(D(2023, 11, 1), "a", 7, 7, 1.0),
    )
    as_of = serving.latest(returns, "period_date")
    assert [(r[0], r[3], r[4]) for r in serving.return_trends(returns, 6, as_of).collect()] == [(D(2024, 1, 1), 10, 5), (D(2024, 6, 1), 7, 3)]
    assert rows(serving.returns_by_category(returns, 90, as_of), "category", "total_orders") == [("Unknown", 2), ("x", 5)]
    assert [r["product_id"] for r in serving.top_returned_products(returns, 2).collect()] == ["a", "b"]
    last = serving.latest_return_kpi(returns).first()
    assert (last["returned_orders"], last["return_rate"]) == (3, pytest.approx(3 / 7))


def test_pages_and_presets(spark):
    df = spark.range(25).withColumnRenamed("id", "k")
    assert [r[0] for r in serving.paged(df, "k", 2, 10).collect()] == list(range(20, 25))
    assert [range_days(p) for p in ("7d", "30d", "90d", "6mo", "odd", None)] == [7, 30, 90, 180, 30, 30]
    assert [range_months(p) for p in ("7d", "90d", "6mo", None)] == [1, 3, 6, 1]


def test_contains_text_is_literal(frame):
    df = frame("s string", ("A.B",), ("axb",), (None,))
    assert rows(df.where(contains_text("s", "a.b"))) == [("A.B",)]


RUNS = "run_id string, stage string, start_time timestamp, end_time timestamp, records_processed bigint, records_failed bigint, quality_passed boolean, pii_events_masked bigint, status string"


@pytest.fixture
def runs(frame):
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m, tzinfo=dt.timezone.utc)
    return frame(
        RUNS, ("r1", "silver", t(1), t(1, 1), 10, 1, None, 5, "success"), ("r1", "gold", t(1, 1), t(1, 3), 9, 0, True, 0, "success"),
        ("r2", "silver", t(3), t(3, 2), 4, 4, None, 1, "failed"), ("r3", "silver", t(5), None, 0, 0, None, 0, "running"),
    )


def test_run_queries(runs):
    view = ops.run_view(runs)
    assert rows(view, "run_id", "records_processed", "quality_passed", "status") == [("r1", 19, True, "success"), ("r2", 4, None, "failed"), ("r3", 0, None, "running")]
    assert [r["run_id"] for r in ops.recent_runs(view, 2).collect()] == ["r3", "r2"]
    assert ops.last_success(view).first()["run_id"] == "r1"
    assert ops.today_totals(view, F.lit("2024-01-01").cast("date")).first()[:] == (23, 6)
    assert ops.today_totals(view, F.lit("2024-01-02").cast("date")).first()[:] == (0, 0)
    assert ops.run_stats(view).first()[:] == (1, 1, 150.0)
    assert rows(ops.runs_by_day_status(view), "status", "runs") == [("failed", 1), ("running", 1), ("success", 1)]


def test_validation_queries(frame, runs):
    t = lambda h: dt.datetime(2024, 1, 1, h, tzinfo=dt.timezone.utc)
    log = frame(
        "pipeline_run_id string, checkpoint_name string, suite_name string, success boolean, evaluated_expectations bigint, successful_expectations bigint, unsuccessful_expectations bigint, run_time timestamp",
        ("r1", "c", "s", True, 5, 5, 0, t(1)), ("r2", "c", "s", False, 5, 4, 1, t(2)), ("r3", "c", "s", False, 0, 0, 5, t(3)),
    )
    assert [r["run_id"] for r in ops.validation_results(log, n=2).collect()] == ["r3", "r2"]
    assert [r["run_id"] for r in ops.validation_results(log, run_id="r1").collect()] == ["r1"]
    assert ops.validation_results(log, failed_only=True).count() == 2
    assert ops.checkpoint_status(log).select("passed", "total", F.hour("last_success")).first()[:] == (1, 3, 1)
    assert [r["pass_rate"] for r in ops.pass_rate_trend(log).collect()] == [1.0, 0.8, None]
    totals = {(r[0], r[1]): r[2] for r in ops.panel_totals(log, runs).collect()}
    assert totals["checkpoints_passing", "c"] == 1.0 and totals["expectations_failed", "c"] == 6.0 and totals["rows_processed", "silver"] == 14.0


def test_rates_and_pii_log(frame):
    t = lambda m, s=0: dt.datetime(2024, 1, 1, 10, m, s, tzinfo=dt.timezone.utc)
    events = frame("event_type string, event_timestamp timestamp", ("a", t(0)), ("a", t(4, 59)), ("a", t(5)), ("b", t(7)))
    got = ops.event_rate_5m(events).select(F.minute("window_start"), "event_type", "events")
    assert rows(got) == [(0, "a", 2), (5, "a", 1), (5, "b", 1)]
    direct = events.groupBy(F.window("event_timestamp", "1 hour", "5 minutes").alias("w"), "event_type").agg(F.count("*").alias("n"))
    assert rows(ops.event_rate_1h(events), "window_start", "event_type", "events") == rows(direct.select(F.col("w.start").alias("window_start"), "event_type", F.col("n").alias("events")))
    both = ops.throughput_in_out(events, events.where("event_type = 'a'")).first()
    assert (both["events_in"], both["records_out"]) == (4, 3)
    audit = frame("record_id string, event_id string, field_name string, masking_action string, original_length int, pipeline_run_id string, masked_at timestamp",
                  ("1", "1", "name", "replace", 3, "r", t(0)), ("2", "2", "name", "replace", 6, "r", t(9)), ("1", "1", "mail", "hash", 5, "r", t(0)))
    assert [(r[0], r[1], r[3]) for r in ops.pii_summary(audit).collect()] == [("name", 2, 4.5), ("mail", 1, 5.0)]
    assert ops.pii_totals(audit).first()[:] == (2, 3)
    assert ops.pii_hourly_volume(audit, 7, F.lit("2024-01-08 10:00:00").cast("timestamp")).first()["events"] == 1
    assert [r["record_id"] for r in ops.recent_pii_events(audit, 1).collect()] == ["2"]
    assert ops.pii_rate_1h(audit).count() == 13
