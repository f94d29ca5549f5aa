"""Dashboard queries over the stored marts and dimensions.

``as_of`` is the day a range reaches back from; it defaults to today. Rates and order values of a group
come from its summed parts, not from averages of averages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.exprs import contains_text, ratio, since_days, since_months

HEATMAP_WEEKS = tuple(range(13))
HEATMAP_COHORTS = 12
ALERT_RANK = {"red": 1, "yellow": 2, "green": 3}


def latest(df: DataFrame, column: str) -> Column:
    """The table's greatest value of a column, as a scalar subquery."""
    return df.select(F.max(column)).scalar()


def _today(as_of: Column | None) -> Column:
    return F.current_date() if as_of is None else as_of


# --- sales ----------------------------------------------------------------------------------------


def daily_sales_trend(sales: DataFrame, days: int = 30, as_of: Column | None = None) -> DataFrame:
    recent = sales.where(F.col("period_date") >= since_days(_today(as_of), days))
    daily = recent.groupBy("period_date").agg(
        F.sum("total_gmv").alias("total_gmv"), F.sum("total_orders").alias("total_orders")
    )
    value = ratio(F.col("total_gmv"), F.col("total_orders"))
    return daily.withColumn("avg_order_value", value).orderBy("period_date")


def sales_by_category(sales: DataFrame, days: int = 30, top: int = 10, as_of: Column | None = None) -> DataFrame:
    recent = sales.where(F.col("period_date") >= since_days(_today(as_of), days))
    groups = recent.groupBy(F.coalesce("category", F.lit("Unknown")).alias("category")).agg(
        F.sum("total_gmv").alias("total_gmv"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("returned_orders").alias("returned_orders"),
    )
    rate = ratio(F.col("returned_orders"), F.col("total_orders"))
    named = groups.select("category", "total_gmv", "total_orders", rate.alias("return_rate"))
    return named.orderBy(F.col("total_gmv").desc(), "category").limit(top)


def home_kpis(sales: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: GMV, orders and order value of the last sales day, open alerts of the last snapshot day."""
    none = F.lit(0).cast("bigint")
    day = sales.where(F.col("period_date") == latest(sales, "period_date")).agg(
        F.coalesce(F.sum("total_gmv"), F.lit(0).cast("decimal(32,2)")).alias("gmv"),
        F.coalesce(F.sum("total_orders"), none).alias("orders"),
    )
    open_alerts = alerts.where(
        (F.col("snapshot_date") == latest(alerts, "snapshot_date")) & F.col("alert_level").isin("red", "yellow")
    ).agg(F.count("*").alias("n"))
    return day.select(
        F.col("gmv").alias("today_gmv"),
        F.col("orders").alias("today_orders"),
        ratio(F.col("gmv"), F.col("orders")).alias("today_aov"),
        open_alerts.scalar().alias("active_sku_alerts"),
    )


# --- customers ------------------------------------------------------------------------------------


def cohort_table(cohorts: DataFrame, weeks: int = 12, rows: int = 500) -> DataFrame:
    return (
        cohorts.where(F.col("weeks_since_acquisition") <= weeks)
        .orderBy(F.col("cohort_week").desc(), F.col("weeks_since_acquisition"))
        .limit(rows)
    )


def cohort_heatmap(cohorts: DataFrame, top: int = HEATMAP_COHORTS) -> DataFrame:
    """Newest cohorts as rows, weeks 0 to 12 as columns holding the retention rate."""
    shown = cohorts.where(F.col("weeks_since_acquisition") <= HEATMAP_WEEKS[-1])
    newest = shown.select("cohort_week").distinct().orderBy(F.col("cohort_week").desc()).limit(top)
    grid = (
        shown.join(F.broadcast(newest), "cohort_week", "left_semi")  # at most ``top`` rows
        .groupBy("cohort_week")
        .pivot("weeks_since_acquisition", list(HEATMAP_WEEKS))
        .agg(F.first("retention_rate"))
    )
    named = [F.col(str(w)).alias(f"week_{w}") for w in HEATMAP_WEEKS]
    return grid.select("cohort_week", *named).orderBy(F.col("cohort_week").desc())


def retention_band(rate: Column) -> Column:
    return F.when(rate >= 0.4, "strong").when(rate >= 0.2, "fair").when(rate >= 0.1, "weak").otherwise("poor")


def cohort_bands(cohorts: DataFrame) -> DataFrame:
    """Cells of the cohort table per retention band."""
    shown = cohorts.where(F.col("weeks_since_acquisition") <= HEATMAP_WEEKS[-1])
    return shown.groupBy(retention_band(F.col("retention_rate")).alias("band")).agg(F.count("*").alias("cells"))


def customer_tier_summary(customers: DataFrame) -> DataFrame:
    spent = F.sum(F.coalesce("total_spent", F.lit(0)))
    n = F.count("*")
    tiers = [F.count_if(F.col("tier") == t).alias(f"{t}_count") for t in ("bronze", "silver", "gold")]
    return customers.agg(n.alias("total_customers"), F.coalesce(ratio(spent, n), F.lit(0.0)).alias("avg_total_spent"), *tiers)


# --- inventory ------------------------------------------------------------------------------------


def alert_rank(level: Column) -> Column:
    rank = F.lit(4)
    for name, n in ALERT_RANK.items():
        rank = F.when(level == name, n).otherwise(rank)
    return rank


def inventory_alerts_filtered(
    alerts: DataFrame,
    level: str | None = None,
    category: str | None = None,
    search: str | None = None,
    sort_by: str = "alert_level",
    descending: bool = False,
) -> DataFrame:
    """Alert rows by optional level, category and product name text.

    ``sort_by`` is ``alert_level`` (red first, then the fewest days left), ``product_name`` or
    ``days_of_stock_remaining``; unknown days count as endless.
    """
    rows = alerts
    if level:
        rows = rows.where(F.col("alert_level") == level)
    if category:
        rows = rows.where(F.col("category") == category)
    if search and search.strip():
        rows = rows.where(contains_text("product_name", search.strip()))
    days = F.col("days_of_stock_remaining")
    if descending:
        by_days, rank, name = days.desc_nulls_first(), alert_rank(F.col("alert_level")).desc(), F.col("product_name").desc()
    else:
        by_days, rank, name = days.asc_nulls_last(), alert_rank(F.col("alert_level")).asc(), F.col("product_name").asc()
    orders = {"alert_level": [rank, by_days], "product_name": [name], "days_of_stock_remaining": [by_days]}
    return rows.orderBy(*orders[sort_by], "product_id")


def inventory_stats(alerts: DataFrame) -> DataFrame:
    level = F.col("alert_level")
    return alerts.agg(
        F.count("*").alias("total_skus"),
        F.count_if(level == "red").alias("red_alerts"),
        F.count_if(level == "yellow").alias("yellow_alerts"),
        F.count_if(level == "green").alias("green_skus"),
    )


# --- returns --------------------------------------------------------------------------------------


def return_trends(returns: DataFrame, months: int = 6, as_of: Column | None = None) -> DataFrame:
    recent = returns.where(F.col("period_date") >= since_months(_today(as_of), months))
    monthly = recent.groupBy("period_date", "year", "month").agg(
        F.sum("total_orders").alias("total_orders"), F.sum("returned_orders").alias("returned_orders")
    )
    rate = ratio(F.col("returned_orders"), F.col("total_orders"))
    return monthly.withColumn("return_rate", rate).orderBy("period_date")


def returns_by_category(returns: DataFrame, days: int = 90, as_of: Column | None = None) -> DataFrame:
    recent = returns.where(F.col("period_date") >= since_days(_today(as_of), days))
    groups = recent.groupBy(F.coalesce("category", F.lit("Unknown")).alias("category")).agg(
        F.sum("total_orders").alias("total_orders"), F.sum("returned_orders").alias("returned_orders")
    )
    rate = ratio(F.col("returned_orders"), F.col("total_orders"))
    return groups.withColumn("return_rate", rate).orderBy(F.col("return_rate").desc(), "category")


def top_returned_products(returns: DataFrame, top: int = 10) -> DataFrame:
    last = returns.where(F.col("period_date") == latest(returns, "period_date"))
    shown = last.select("product_id", "product_name", "category", "return_rate", "returned_orders", "return_rate_change")
    return shown.orderBy(F.col("return_rate").desc(), "product_id").limit(top)


def latest_return_kpi(returns: DataFrame) -> DataFrame:
    """One row: return rate and returned orders of the last month."""
    last = returns.where(F.col("period_date") == latest(returns, "period_date"))
    summed = last.groupBy("period_date").agg(
        F.sum("total_orders").alias("total_orders"), F.sum("returned_orders").alias("returned_orders")
    )
    rate = ratio(F.col("returned_orders"), F.col("total_orders"))
    return summed.select("period_date", "returned_orders", rate.alias("return_rate"))


SEEK_BLOCK_BYTES = 1 << 20  # small row groups, so that little is read besides a page


def paged(df: DataFrame, key: str, page: int, size: int = 1000) -> DataFrame:
    """One page in key order, for a client that cannot take the whole table."""
    return df.orderBy(key).offset(page * size).limit(size)


def store_sorted(df: DataFrame, path: str, key: str) -> DataFrame:
    """Store a table in key order: files hold ranges of the key, and their row groups say which."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").option("parquet.block.size", SEEK_BLOCK_BYTES).parquet(path)
    return df.sparkSession.read.parquet(path)


def page_after(sorted_table: DataFrame, key: str, after: object = None, size: int = 1000) -> DataFrame:
    """The page behind the last key of the page before (None: the first), for a key without repeats.

    The bound reaches the scan, which skips files and row groups below it, and the limit keeps the smallest keys of each task:
    no page gathers the rows before it.
    """
    rest = sorted_table if after is None else sorted_table.where(F.col(key) > F.lit(after))
    return rest.orderBy(key).limit(size)
