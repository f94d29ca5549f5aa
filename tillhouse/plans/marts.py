"""Reporting marts over the staging views and the calendar.

Each mart counts and sums the order rows first and looks attributes up on the small result, so that
the joins move groups rather than orders. Natural ids are the link: a surrogate key stands for exactly
one of them. ``customers`` and ``products`` hold one row per id, which the key checks enforce.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.functions.exprs import month_start, share, week_start
from tillhouse.operators.dedup import keep_first
from tillhouse.plans.star import progressed, stock_status

RETURNED = "returned"


def _in_calendar(df: DataFrame, day: str, dates: DataFrame, how: str) -> DataFrame:
    """Add ``full_date``: the day if the calendar has it. The calendar grows only with days."""
    return df.join(F.broadcast(dates.select("full_date")), F.col(day) == F.col("full_date"), how)


def _returns() -> Column:
    return F.count_if(F.col("status") == RETURNED)


def mart_sales_summary(orders: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    """Per day, category and subcategory: orders, GMV, order value, customers, items, return rate.

    The first grouping also holds the customer, so that the distinct count becomes a plain count of
    known customers in the second one and no group is larger than its customers.
    """
    kinds = products.select("product_id", "category", "subcategory")
    lines = _in_calendar(orders.where(progressed()), "order_date", dates, "left").join(kinds, "product_id", "left")
    grain = ["full_date", "category", "subcategory"]
    per_customer = lines.groupBy(*grain, "customer_id").agg(
        F.count("*").alias("n"),
        F.sum("order_amount").alias("gmv"),
        F.sum("quantity").alias("items"),
        _returns().alias("back"),
    )
    known = customers.select("customer_id", F.lit(True).alias("known"))
    n, gmv = F.col("total_orders"), F.col("total_gmv")
    groups = per_customer.join(known, "customer_id", "left").groupBy(*grain).agg(
        F.sum("n").alias("total_orders"),
        F.sum("gmv").cast("decimal(22,2)").alias("total_gmv"),
        F.count("known").alias("unique_customers"),
        F.sum("items").alias("total_items_sold"),
        F.sum("back").alias("returned_orders"),
    )
    calendar = F.broadcast(dates.select("full_date", "year", "month", "week_of_year"))
    return groups.join(calendar, "full_date", "left").select(
        F.col("full_date").alias("period_date"), "year", "month", "week_of_year", "category", "subcategory",
        "total_orders", "total_gmv",
        F.round(gmv / n, 2).cast("decimal(22,2)").alias("avg_order_value"),
        "unique_customers", "total_items_sold", "returned_orders",
        share(F.col("returned_orders"), n).alias("return_rate"),
    )


def mart_return_rates(orders: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    """Per product and month: return rate and its change since the product's previous sales month."""
    dated = _in_calendar(orders, "order_date", dates, "inner")
    monthly = dated.groupBy("product_id", month_start("full_date").alias("period_date")).agg(
        F.count("*").alias("total_orders"), _returns().alias("returned_orders")
    )
    rate = share(F.col("returned_orders"), F.col("total_orders"))
    named = monthly.join(products.select("product_id", "product_name", "category"), "product_id")
    before = F.lag("return_rate").over(Window.partitionBy("product_id").orderBy("period_date"))
    return (
        named.withColumn("return_rate", rate)
        .withColumn("prev_month_return_rate", before)
        .select(
            F.year("period_date").alias("year"), F.month("period_date").alias("month"), "period_date",
            "product_id", "product_name", "category", "total_orders", "returned_orders", "return_rate",
            "prev_month_return_rate",
            (F.col("return_rate") - F.col("prev_month_return_rate")).alias("return_rate_change"),
        )
    )


def mart_customer_cohorts(orders: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Weekly cohorts by registration week: customers active N weeks later and their share."""
    members = customers.where(F.col("registration_date").isNotNull()).select(
        "customer_id", week_start("registration_date").alias("cohort_week")
    )
    weeks = (
        _in_calendar(orders, "order_date", dates, "inner")
        .select("customer_id", week_start("full_date").alias("order_week"))
        .distinct()
    )
    gap = F.floor(F.datediff("order_week", "cohort_week") / 7).cast("int")
    active = (
        weeks.join(members, "customer_id")
        .where(F.col("order_week") >= F.col("cohort_week"))
        .groupBy("cohort_week", gap.alias("weeks_since_acquisition"))
        .agg(F.count("*").alias("active_customers"))
    )
    sizes = members.groupBy("cohort_week").agg(F.count("*").alias("customers_in_cohort"))
    # one row per week of the calendar, so the size of this side is bounded
    return active.join(F.broadcast(sizes), "cohort_week").select(
        "cohort_week", "weeks_since_acquisition", "customers_in_cohort", "active_customers",
        share(F.col("active_customers"), F.col("customers_in_cohort")).alias("retention_rate"),
    )


def alert_level(stock: Column, threshold: Column) -> Column:
    """Strict limits: stock equal to the threshold is yellow, equal to 1.2 times it is green."""
    return (
        F.when(stock < threshold, "red")
        .when(stock * 10 < threshold * 12, "yellow")
        .otherwise("green")
    )


def mart_inventory_alerts(
    inventory: DataFrame, velocity: DataFrame, products: DataFrame, dates: DataFrame
) -> DataFrame:
    """Alert level of every product at its latest snapshot inside the calendar."""
    ties = ["stock_level", "reorder_threshold", "units_sold", "units_received"]
    dated = _in_calendar(inventory, "inventory_date", dates, "left_semi")
    latest = keep_first(dated, ["product_id"], [F.col("inventory_date").desc(), *ties])
    attributes = products.select("product_id", "product_name", "category", "subcategory", "supplier_id")
    status = stock_status(latest, velocity).join(attributes, "product_id")
    return status.select(
        "product_id", "product_name", "category", "subcategory", "supplier_id",
        F.col("stock_level").alias("current_stock_level"),
        "reorder_threshold", "days_of_stock_remaining",
        alert_level(F.col("stock_level").cast("bigint"), F.col("reorder_threshold").cast("bigint")).alias("alert_level"),
        F.col("inventory_date").alias("snapshot_date"),
    )
