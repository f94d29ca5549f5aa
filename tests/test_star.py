from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from collected import rows
from tillhouse.operators import history, keys, upsert
from tillhouse.plans import marts, star

D = dt.date
ORDERS = (
    "order_id string, customer_id string, product_id string, quantity int, unit_price decimal(12,2), "
    "order_amount decimal(12,2), order_date date, status string, card_type string"
)
CUSTOMERS = "customer_id string, hashed_email string, tier string, registration_date date"
PRODUCTS = (
    "product_id string, product_name string, category string, subcategory string, unit_price decimal(12,2), "
    "cost_price decimal(12,2), supplier_id string, reorder_threshold int, current_stock int"
)
INVENTORY = "product_id string, inventory_date date, stock_level int, reorder_threshold int, units_sold int, units_received int"


def order(i, c="c1", p="p1", q=1, amount="10.00", day=D(2024, 1, 1), status="paid"):
    return (i, c, p, q, Decimal("1.00"), Decimal(amount), day, status, None)


def product(p="p1", price="10.00", cost="5.00", name="Lamp", category="Home", sub="Light", threshold=10, stock=1):
    money = lambda x: None if x is None else Decimal(x)
    return (p, name, category, sub, money(price), money(cost), "s", threshold, stock)


@pytest.fixture
def dates(spark):
    return star.dim_date(spark, "2023-12-25", "2025-01-31")


def half_up(x, digits):
    return Decimal(x).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


# --- keys -----------------------------------------------------------------------------------------


def test_dense_key_is_the_rank(spark):
    rng = random.Random(1)
    names = [f"k{rng.randrange(10**9)}" for _ in range(5000)]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, v int").repartition(7)
    got = keys.dense_key(df, ["name"], "id").select("id", "name").collect()
    assert [r["name"] for r in sorted(got)] == sorted(names)
    assert sorted(r["id"] for r in got) == list(range(1, 5001))


def test_dense_key_splits_a_hot_value(spark):
    df = spark.range(8000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    got = keys.dense_key(df, ["k"], "id")
    assert got.select(F.min("id"), F.max("id"), F.count_distinct("id")).first()[:] == (1, 8000, 8000)
    hot = got.where("k = 0")
    assert hot.agg(F.max("id")).first()[0] == hot.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Sort [k" not in plan  # the numbering itself neither sorts nor shuffles the rows again


def test_dense_key_of_an_empty_table(frame):
    assert keys.dense_key(frame("a string, b int", ("x", 1)).where("b > 1"), ["a"], "id").count() == 0


def test_hash_key_is_stable(frame):
    df = frame("a string, b int", ("x", 1), ("y", 2))
    assert rows(keys.hash_key(df, ["a"], "id")) == rows(keys.hash_key(df.repartition(3), ["a"], "id"))


# --- dimensions and facts -------------------------------------------------------------------------


def test_dim_date(dates):
    got = {str(r["full_date"]): r for r in dates.collect()}
    assert len(got) == 404
    edge = got["2024-12-30"]
    assert (edge["date_key"], edge["week_of_year"], edge["day_of_week"], edge["day_name"], edge["month_name"], edge["quarter"], edge["is_weekend"]) == (
        20241230, 1, 1, "Monday", "December", 4, False,
    )
    assert got["2024-03-02"]["is_weekend"] and got["2024-03-03"]["day_of_week"] == 7


def test_customer_totals(frame):
    customers = frame(CUSTOMERS, ("c1", "h", "gold", None), ("c2", "h", None, None), ("c3", "h", None, None))
    orders = frame(ORDERS, order("1"), order("2", amount="2.50"), order("3", status="placed"), order("4", c="c3", status=None), order("5", c="zz"))
    got = star.dim_customers(customers, orders)
    assert rows(got, "customer_key", "customer_id", "total_orders", "total_spent") == [
        (1, "c1", 2, Decimal("12.50")), (2, "c2", 0, Decimal("0.00")), (3, "c3", 0, Decimal("0.00")),
    ]


@pytest.mark.parametrize(("price", "cost", "margin"), [
    ("10.00", "5.00", "50.00"), ("0.00", "5.00", None), (None, "5.00", None), ("10.00", None, None), ("3.00", "1.00", "66.67"),
    ("10.00", "12.00", "-20.00"), ("800.00", "799.96", "0.01"), ("1000.00", "999.95", "0.01"),
])
def test_margin(frame, price, cost, margin):
    got = star.product_rows(frame(PRODUCTS, product(price=price, cost=cost))).first()["margin_pct"]
    assert got == (None if margin is None else Decimal(margin))


def test_fact_orders_orphans_and_dates(frame, dates):
    customers = frame("customer_id string, customer_key long", ("c1", 1))
    products = frame("product_id string, product_key long", ("p1", 7))
    orders = frame(ORDERS, order("b", status="returned"), order("a", c="nobody", p="nothing", day=D(2030, 1, 1)), order("c", status=None))
    got = star.fact_orders(orders, customers, products, dates)
    assert rows(got, "order_key", "order_id", "customer_key", "product_key", "date_key", "is_returned") == [
        (1, "a", None, None, None, False), (2, "b", 1, 7, 20240101, True), (3, "c", 1, 7, 20240101, None),
    ]


def test_fact_events(spark, frame, dates):
    events = frame(
        "event_id string, event_type string, t string, order_id string, customer_id string, product_id string, quantity int, order_amount decimal(12,2), status string",
        ("e2", "order_placed", "2024-01-01 10:00:00", "o", "c1", None, 1, Decimal("1.00"), "placed"),
        ("e1", "order_placed", "2024-01-01 10:00:00", "o", "c9", "p1", 1, None, None),
        ("e0", "order_placed", "2024-01-02 00:00:00", "o", "c1", "p1", 1, None, None),
    ).withColumn("event_timestamp", F.col("t").cast("timestamp"))
    got = star.fact_events(events, frame("customer_id string, customer_key long", ("c1", 1)), frame("product_id string, product_key long", ("p1", 7)), dates)
    assert rows(got, "event_key", "event_id", "customer_key", "product_key", "date_key") == [
        (1, "e1", None, 7, 20240101), (2, "e2", 1, None, 20240101), (3, "e0", 1, 7, 20240102),
    ]


def test_inventory_velocity_and_days(frame, dates):
    orders = frame(
        ORDERS,
        order("1", q=3), order("2", q=2, day=D(2024, 1, 11)), order("3", p="p2", q=9, status="placed", day=D(2024, 1, 20)),
        order("4", p="p3", q=1, status=None), order("5", p="p4", q=1, day=D(2030, 1, 1)),
    )
    velocity = star.inventory_velocity(orders, dates)
    assert rows(velocity, "product_id", "units_sold", "total_days") == [("p1", 5, 20), ("p4", 1, 20)]
    inventory = frame(INVENTORY, ("p1", D(2024, 1, 2), 7, 7, 0, 0), ("p1", D(2024, 1, 1), 0, 7, 0, 0), ("p2", D(2024, 1, 1), 5, 7, 0, 0), ("zz", D(2024, 1, 1), 5, 7, 0, 0))
    facts = star.fact_inventory_snapshots(inventory, velocity, frame("product_id string, product_key long", ("p1", 1), ("p2", 2)), dates)
    assert rows(facts, "snapshot_key", "product_key", "date_key", "is_below_reorder", "days_of_stock_remaining") == [
        (1, 1, 20240101, True, Decimal("0.0")), (2, 1, 20240102, False, Decimal("28.0")), (3, 2, 20240101, True, None), (4, None, 20240101, True, None),
    ]


def test_backfills(frame):
    customers = frame("customer_id string, total_orders int, total_spent double", ("c1", 9, 9.0), ("c2", 9, 9.0))
    got = star.backfill_customer_stats(customers, frame(ORDERS, order("1"), order("2", status="placed")))
    assert rows(got, "customer_id", "total_orders", "total_spent") == [("c1", 2, Decimal("20.00")), ("c2", 0, Decimal("0.00"))]
    stock = frame("product_id string, date date, stock_level int", ("p1", D(2024, 1, 1), 5), ("p1", D(2024, 1, 3), 8), ("p1", D(2024, 1, 2), 6))
    got = star.backfill_current_stock(frame(PRODUCTS, product(stock=1), product("p2", stock=4)), stock)
    assert rows(got, "product_id", "current_stock") == [("p1", 8), ("p2", 4)]


# --- marts ----------------------------------------------------------------------------------------


def random_orders(seed, n=400):
    rng = random.Random(seed)
    status = ["placed", "paid", "shipped", "delivered", "returned", None]
    return [
        order(f"o{i}", c=rng.choice(["c1", "c2", "c3", "ghost", None]), p=rng.choice(["p1", "p2", "p3", "lost"]), q=rng.randrange(1, 5),
              amount=f"{rng.randrange(1, 9999) / 100:.2f}", day=D(2024, 1, 1) + dt.timedelta(days=rng.randrange(8) * 17), status=rng.choice(status))
        for i in range(n)
    ]


def catalog(frame):
    return frame(PRODUCTS, product("p1"), product("p2", category="Home", sub="Chair", name="Seat"), product("p3", category=None, sub=None))


def members(frame):
    return frame(CUSTOMERS, ("c1", "h", "gold", D(2024, 1, 1)), ("c2", "h", None, D(2024, 2, 1)), ("c3", "h", None, None), ("c4", "h", None, D(2024, 1, 3)))


def test_sales_summary_against_brute_force(frame, dates):
    given = random_orders(5)
    kinds = {"p1": ("Home", "Light"), "p2": ("Home", "Chair"), "p3": (None, None), "lost": (None, None)}
    groups = defaultdict(list)
    for o in given:
        if o[7] not in (None, "placed"):
            groups[(o[6], *kinds[o[2]])].append(o)
    want = []
    for (day, cat, sub), found in groups.items():
        n, gmv, back = len(found), sum(o[5] for o in found), sum(o[7] == "returned" for o in found)
        known = {o[1] for o in found} & {"c1", "c2", "c3"}
        want.append((day, cat, sub, n, gmv, half_up(gmv / n, 2), len(known), sum(o[3] for o in found), back, half_up(Decimal(back) / n, 4)))
    got = marts.mart_sales_summary(frame(ORDERS, *given), members(frame), catalog(frame), dates)
    columns = "period_date category subcategory total_orders total_gmv avg_order_value unique_customers total_items_sold returned_orders return_rate".split()
    assert rows(got, *columns) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_sales_rounding_tie_goes_up(frame, dates):
    given = [order("1", amount="69567.78"), order("2", amount="0.01")]
    got = marts.mart_sales_summary(frame(ORDERS, *given), members(frame), catalog(frame), dates).first()
    assert got["avg_order_value"] == Decimal("34783.90")


def test_return_rates(frame, dates):
    months = [(D(2024, 1, 5), "returned"), (D(2024, 1, 6), "paid"), (D(2024, 3, 1), "placed"), (D(2024, 3, 2), None), (D(2024, 4, 1), "returned")]
    given = [order(f"{i}", day=d, status=s) for i, (d, s) in enumerate(months)] + [order("x", p="lost", status="returned"), order("y", day=D(2030, 1, 1))]
    got = marts.mart_return_rates(frame(ORDERS, *given), catalog(frame), dates)
    assert rows(got, "year", "month", "product_id", "total_orders", "returned_orders", "return_rate", "prev_month_return_rate", "return_rate_change") == [
        (2024, 1, "p1", 2, 1, Decimal("0.5000"), None, None),
        (2024, 3, "p1", 2, 0, Decimal("0.0000"), Decimal("0.5000"), Decimal("-0.5000")),
        (2024, 4, "p1", 1, 1, Decimal("1.0000"), Decimal("0.0000"), Decimal("1.0000")),
    ]


def test_cohorts(frame, dates):
    given = [
        order("1", c="c1", day=D(2024, 1, 2)), order("2", c="c1", day=D(2024, 1, 3), status="placed"), order("3", c="c1", day=D(2024, 1, 15)),
        order("4", c="c2", day=D(2024, 1, 1)), order("5", c="c2", day=D(2024, 1, 29)), order("6", c="c3"), order("7", c="ghost"),
    ]
    got = marts.mart_customer_cohorts(frame(ORDERS, *given), members(frame), dates)
    assert rows(got) == [
        (D(2024, 1, 1), 0, 2, 1, Decimal("0.5000")), (D(2024, 1, 1), 2, 2, 1, Decimal("0.5000")), (D(2024, 1, 29), 0, 1, 1, Decimal("1.0000")),
    ]


@pytest.mark.parametrize(("stock", "threshold", "level"), [
    (9, 10, "red"), (10, 10, "yellow"), (11, 10, "yellow"), (12, 10, "green"), (0, 0, "green"), (None, 10, "green"), (5, None, "green"),
    (17, 15, "yellow"), (18, 15, "green"),
])
def test_alert_level(frame, stock, threshold, level):
    got = frame("s bigint, t bigint", (stock, threshold)).select(marts.alert_level(F.col("s"), F.col("t"))).first()[0]
    assert got == level


def test_inventory_alerts_use_the_latest_snapshot(frame, dates):
    inventory = frame(
        INVENTORY,
        ("p1", D(2024, 1, 1), 0, 10, 0, 0), ("p1", D(2024, 1, 9), 50, 10, 0, 0), ("p2", D(2024, 1, 1), 1, 10, 0, 0), ("lost", D(2024, 1, 1), 1, 10, 0, 0),
        ("p2", D(2040, 1, 1), 99, 10, 0, 0),
    )
    velocity = star.inventory_velocity(frame(ORDERS, order("1", q=5), order("2", day=D(2024, 1, 10), q=5)), dates)
    got = marts.mart_inventory_alerts(inventory, velocity, catalog(frame), dates)
    assert rows(got, "product_id", "current_stock_level", "alert_level", "days_of_stock_remaining", "snapshot_date") == [
        ("p1", 50, "green", Decimal("50.0"), D(2024, 1, 9)), ("p2", 1, "red", None, D(2024, 1, 1)),
    ]


# --- history and upsert ---------------------------------------------------------------------------

PEOPLE = "customer_id string, hashed_email string, tier string, total_orders bigint, total_spent decimal(12,2)"
CHECKS = ("tier", "total_spent", "total_orders")


def person(i, tier="gold", n=1, spent="1.00", mail="h"):
    return (i, mail, tier, n, None if spent is None else Decimal(spent))


def test_history_transitions(frame):
    first = frame(PEOPLE, person("same"), person("mail"), person("tier"), person("to_null"), person("from_null", tier=None), person("gone"))
    second = frame(PEOPLE, person("same"), person("mail", mail="new"), person("tier", tier="silver"), person("to_null", spent=None), person("from_null"), person("new"))
    third = frame(PEOPLE, person("same"), person("gone"), person("new", n=2))
    h = history.empty_history(first)
    for current, at in ((first, "2024-01-01"), (second, "2024-02-01"), (third, "2024-03-01")):
        h = history.apply_snapshot(h, current, "customer_id", CHECKS, at)
    got = h.select("customer_id", F.date_format("valid_from", "MM").alias("a"), F.date_format("valid_to", "MM").alias("b"), "is_current", "hashed_email")
    assert rows(got) == sorted([
        ("same", "01", None, True, "h"), ("mail", "01", "03", False, "h"),
        ("tier", "01", "02", False, "h"), ("tier", "02", "03", False, "h"),
        ("to_null", "01", "02", False, "h"), ("to_null", "02", "03", False, "h"),
        ("from_null", "01", "02", False, "h"), ("from_null", "02", "03", False, "h"),
        ("gone", "01", "02", False, "h"), ("gone", "03", None, True, "h"),
        ("new", "02", "03", False, "h"), ("new", "03", None, True, "h"),
    ], key=lambda r: tuple((v is None, str(v)) for v in r))
    assert h.select("scd_id").distinct().count() == h.count()


def test_history_has_one_open_version_per_live_key(spark):
    rng = random.Random(11)
    h = None
    for step in range(4):
        live = [person(f"c{i}", tier=rng.choice(["gold", "silver", None]), n=rng.randrange(2)) for i in range(40) if rng.random() < 0.7]
        current = spark.createDataFrame(live, PEOPLE)
        h = history.apply_snapshot(history.empty_history(current) if h is None else h, current, "customer_id", CHECKS, f"2024-0{step + 1}-01")
        opened = h.where("is_current")
        assert rows(opened, "customer_id", "tier", "total_orders") == sorted(((p[0], p[2], p[3]) for p in live), key=lambda r: tuple((v is None, str(v)) for v in r))
    again = history.apply_snapshot(h, current, "customer_id", CHECKS, "2024-09-01")
    assert rows(again, "scd_id", "valid_to") == rows(h, "scd_id", "valid_to")


def test_upsert_changes_only_the_listed_columns(frame):
    table = frame("id string, a int, b int, c int", ("x", 1, 1, 1), ("y", 2, 2, 2))
    updates = frame("id string, a int, b int", ("x", 9, None), ("z", 7, 7))
    got = upsert.upsert_by_key(table, updates, ["id"], ["b"])
    assert rows(got) == [("x", 1, None, 1), ("y", 2, 2, 2), ("z", 7, 7, None)]
