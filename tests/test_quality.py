from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from collected import rows
from tillhouse.operators import expectations as ex
from tillhouse.operators import rules
from tillhouse.plans import checkpoints

SUITE = ex.Suite("s", "checkpoint_s", (
    ex.exists("a"), ex.exists("nope"), ex.not_null("a"), ex.unique("a"), ex.in_set("b", "x", "y"), ex.between("n", 0.01, 50000),
    ex.matches("h", "^[a-f0-9]{4}$"), ex.row_count_between(1, 5), ex.not_null("nope"),
))
SCHEMA = "a string, b string, n double, h string"


def result(df, suite=SUITE, by=()):
    return {r["rule_no"]: (r["unexpected_count"], r["success"]) for r in ex.run_suite(df, suite, by).collect()}


def test_rules(frame):
    df = frame(SCHEMA, ("1", "x", 0.01, "abcd"), ("1", "z", 50000.0, "ABCD"), (None, None, 50000.01, None), (None, "y", 0.0, "abcde"), ("2", "y", None, "0000"))
    assert result(df) == {
        1: (0, True), 2: (None, False), 3: (2, False), 4: (2, False), 5: (1, False), 6: (2, False), 7: (2, False), 8: (0, True), 9: (None, False),
    }
    summary = ex.summarize(ex.run_suite(df, SUITE)).first()
    assert (summary["evaluated_expectations"], summary["successful_expectations"], summary["unsuccessful_expectations"], summary["success"]) == (9, 2, 7, False)


def test_clean_table_passes(frame):
    suite = ex.Suite("s", "c", tuple(r for r in SUITE.rules if r.column != "nope"))
    summary = ex.summarize(ex.run_suite(frame(SCHEMA, ("1", "x", 1.0, "abcd"), ("2", "y", 2.0, "0000")), suite)).first()
    assert (summary["successful_expectations"], summary["success"]) == (7, True)


def test_empty_table_fails_every_rule(frame):
    summary = ex.summarize(ex.run_suite(frame(SCHEMA, ("1", "x", 1.0, "abcd")).where("a = 'no'"), SUITE)).first()
    assert (summary["evaluated_expectations"], summary["successful_expectations"], summary["unsuccessful_expectations"], summary["success"]) == (0, 0, 9, False)


def test_groups_are_judged_on_their_own(frame):
    df = frame("day int, " + SCHEMA, (1, "1", "x", 1.0, "abcd"), (1, "1", "x", 1.0, "abcd"), (2, "1", "z", 1.0, "abcd"))
    got = {(r["day"], r["rule_no"]): r["unexpected_count"] for r in ex.run_suite(df, SUITE, ["day"]).collect()}
    assert (got[1, 4], got[2, 4], got[1, 5], got[2, 5]) == (2, 0, 0, 1)


def test_detail_and_examples(frame):
    df = frame(SCHEMA, ("1", "q", 1.0, "abcd"), ("2", "w", 1.0, "abcd"))
    detail = json.loads(ex.result_detail(ex.run_suite(df, SUITE)).first()["result_detail"])
    assert [d["rule_no"] for d in detail] == list(range(1, 10)) and detail[4]["unexpected_count"] == 2
    assert rows(ex.failing_examples(df, SUITE.rules[4])) == [("q",), ("w",)]


def test_suite_sizes():
    assert {name: len(s.rules) for name, s in checkpoints.SUITES.items()} == {"events": 20, "customers": 8, "orders": 8, "inventory": 5, "products": 4}


@pytest.mark.parametrize(("newest", "success", "reason"), [
    ("2024-01-30 10:00:00", True, "fresh"), ("2024-01-30 09:59:59.999", False, "older than 2 h"), ("2024-01-30 13:00:00", True, "fresh"),
    (None, False, "all event timestamps are null"),
])
def test_freshness(frame, newest, success, reason):
    df = frame("t string", (newest,), (None,)).select(F.col("t").cast("timestamp").alias("event_timestamp"))
    got = checkpoints.freshness_check(df, F.lit("2024-01-30 12:00:00")).first()
    assert (got["success"], got["reason"]) == (success, reason)


def test_age_of_an_event_ahead_of_the_clock_counts_whole_seconds(frame):
    for newest, age in (("2024-01-30 12:00:25.26", -25), ("2024-01-30 11:59:34.74", 25)):
        df = frame("event_timestamp string", (newest,)).select(F.col("event_timestamp").cast("timestamp"))
        got = checkpoints.freshness_check(df, F.lit("2024-01-30 12:00:00")).first()
        assert (got["age_seconds"], got["success"]) == (age, True)


def test_freshness_without_rows_or_column(frame):
    empty = frame("event_timestamp timestamp, x int", (None, 1)).where("x > 1")
    assert checkpoints.freshness_check(empty, F.lit("2024-01-30 12:00:00")).first()["reason"] == "no rows"
    assert checkpoints.freshness_check(frame("x int", (1,)), F.lit("2024-01-30 12:00:00")).first()["success"] is False


def test_source_freshness(frame):
    loaded = lambda t: frame("t string", (t,)).select(F.col("t").cast("timestamp").alias("_silver_loaded_at"))
    tables = {"a": loaded("2024-01-01 09:00:00"), "b": loaded("2024-01-01 08:59:59"), "c": loaded("2024-01-01 05:59:59"), "d": loaded(None)}
    got = checkpoints.source_freshness(tables, F.lit("2024-01-01 12:00:00"))
    assert rows(got, "table_name", "state") == [("a", "pass"), ("b", "warn"), ("c", "error"), ("d", "error")]


def test_gate(frame):
    summary = frame("checkpoint_name string, success boolean", ("a", True), ("b", False))
    with pytest.raises(checkpoints.GateFailed, match="b"):
        checkpoints.quality_gate(summary)
    checkpoints.quality_gate(summary.where("success"))


def test_generic_tests(frame):
    df = frame("k int, v string", (1, "a"), (1, "b"), (None, "c"), (None, "c"), (3, None))
    assert rules.test_not_null(df, "k").count() == 2
    assert rows(rules.test_unique(df, "k")) == [(1, 2)]
    assert rows(rules.test_accepted_values(df, "v", "a", "b")) == [("c", 2)]
    assert rows(rules.test_relationships(df, "k", frame("id int", (1,), (1,)), "id")) == [(3, None)]


def test_singular_tests(frame):
    schema = "order_id string, status string, order_amount decimal(12,2), quantity int, unit_price decimal(12,2), order_date date"
    day = dt.date(2024, 1, 1)
    row = lambda i, status, amount, q=2, p="1.00", d=day: (i, status, Decimal(amount), q, Decimal(p), d)
    orders = frame(schema, row("a", "paid", "2.00"), row("b", "paid", "0.00"), row("c", "returned", "-1.00"), row("d", "paid", "2.01"),
                   row("e", "paid", "2.02"), row("f", "paid", "1.98", d=day + dt.timedelta(days=1)))
    assert rows(rules.assert_gmv_positive(orders), "order_id") == [("b",)]
    assert rows(rules.assert_amount_matches(orders), "order_id") == [("b",), ("c",), ("e",), ("f",)]
    assert rows(rules.assert_no_future_orders(orders, F.lit("2024-01-01").cast("date")), "order_id") == [("f",)]
    stock = frame("product_id string, reorder_threshold int", ("p", 1), ("q", 2), ("r", 3))
    assert rows(rules.assert_reorder_matches(stock, frame("product_id string, reorder_threshold int", ("p", 1), ("q", 3)))) == [("q",)]


def test_staging_constraints(frame):
    schema = "order_line_id string, order_id string, customer_id string, product_id string, quantity int, order_amount double, order_date date, order_status string"
    day = dt.date(2024, 1, 1)
    orders = frame(schema, ("1", "1", "c", "p", 1, 0.01, day, "paid"), ("1", "1", "c", "p", 0, 50000.01, day, "paid"), ("2", "2", None, "p", 1, 50000.0, day, None))
    got = {r["constraint_name"]: r["violations"] for r in rules.staging_constraints({"orders": orders}).collect()}
    assert {k: v for k, v in got.items() if v} == {
        "not_null:customer_id": 1, "not_null:order_status": 1, "check:quantity_positive": 1, "check:order_amount_in_range": 1, "unique:order_line_id": 1,
    }
    good, bad = rules.split_by_constraints(orders, "orders")
    assert (good.count(), bad.count()) == (1, 2)
    assert rows(bad.select("order_line_id", F.array_join("broken_rules", ",")))[1] == ("2", "not_null:customer_id,not_null:order_status")
    log = frame("status string", ("success",), ("odd",))
    assert rules.staging_constraints({"run_log": log}).first()["violations"] == 1
