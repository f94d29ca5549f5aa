"""Plans and results under one hot key, with broadcasts switched off as for large tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from collected import rows
from tillhouse.operators import rules
from tillhouse.operators.expectations import Suite, run_suite, unique
from tillhouse.plans import marts, star


@pytest.fixture
def large(spark):
    """Settings under which a few thousand rows take the paths of a large table."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_orders(spark, n=30000):
    """Every third order belongs to one customer and one product."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 8).select(
        F.concat(F.lit("O"), "id").alias("order_id"),
        F.when(hot, "C0").otherwise(F.concat(F.lit("C"), F.col("id") % 997)).alias("customer_id"),
        F.when(hot, "P0").otherwise(F.concat(F.lit("P"), F.col("id") % 101)).alias("product_id"),
        (F.col("id") % 5 + 1).cast("int").alias("quantity"),
        F.lit(1).cast("decimal(12,2)").alias("unit_price"),
        (F.col("id") % 700).cast("decimal(12,2)").alias("order_amount"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 40).cast("int")).alias("order_date"),
        F.when(F.col("id") % 7 == 0, "returned").otherwise("paid").alias("status"),
        F.lit(None).cast("string").alias("card_type"),
    )


def keyed(spark, prefix, n, key):
    return spark.range(n).select(F.concat(F.lit(prefix), "id").alias("customer_id" if prefix == "C" else "product_id"), F.col("id").alias(key))


def test_a_hot_customer_is_split_between_tasks(large):
    orders = hot_orders(large)
    dates = star.dim_date(large, "2024-01-01", "2024-12-31")
    linked = star.order_fact_rows(orders, keyed(large, "C", 997, "customer_key"), keyed(large, "P", 101, "product_key"), dates)
    linked.write.format("noop").mode("overwrite").save()
    df = linked.groupBy("customer_key").agg(F.count("*").alias("n"))
    assert df.where("customer_key = 0").first()["n"] >= 10000
    executed = linked.persist()
    try:
        executed.count()
        plan = executed._jdf.queryExecution().withCachedData().toString() + executed._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        executed.unpersist()


def test_marts_hold_with_and_without_broadcast(spark, large):
    orders, dates = hot_orders(spark, 6000), star.dim_date(spark, "2024-01-01", "2024-12-31")
    customers = keyed(spark, "C", 900, "k").select("customer_id", F.lit("2024-01-01").cast("date").alias("registration_date"))
    products = keyed(spark, "P", 101, "k").select("product_id", F.concat(F.lit("n"), "k").alias("product_name"), (F.col("k") % 3).cast("string").alias("category"), F.lit("s").alias("subcategory"))
    got = [rows(m) for m in (
        marts.mart_sales_summary(orders, customers, products, dates), marts.mart_return_rates(orders, products, dates),
        marts.mart_customer_cohorts(orders, customers, dates),
    )]
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, "10MB")
    again = [rows(m) for m in (
        marts.mart_sales_summary(orders, customers, products, dates), marts.mart_return_rates(orders, products, dates),
        marts.mart_customer_cohorts(orders, customers, dates),
    )]
    assert got == again
    naive = orders.join(products, "product_id", "left").join(customers, "customer_id", "left").where("status <> 'placed'").groupBy(
        "order_date", "category", "subcategory"
    ).agg(F.count("*").alias("n"), F.count_distinct(F.when(F.col("registration_date").isNotNull(), F.col("customer_id"))).alias("c"))
    assert rows(naive, "order_date", "category", "n", "c") == [tuple(r[i] for i in (0, 4, 6, 9)) for r in got[0]]


def test_hot_values_are_counted_before_the_shuffle(large):
    df = hot_orders(large, 9000)
    got = run_suite(df, Suite("s", "c", (unique("customer_id"),)))
    assert got.first()["unexpected_count"] == 9000
    assert "partial_count" in got._jdf.queryExecution().executedPlan().toString()
    parents = df.select("customer_id")
    orphans = rules.test_relationships(keyed(large, "C", 2000, "k"), "customer_id", parents, "customer_id")
    assert orphans.count() == 2000 - 997
