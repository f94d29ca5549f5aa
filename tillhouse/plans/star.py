"""Star schema: dimensions and facts.

The ``*_rows`` functions give a table without its surrogate key and stay lazy. The functions named
after a table add the dense key, which writes the table once (see ``operators.keys``): to ``path``, if it is to stay.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.exprs import date_key
from tillhouse.operators.keys import dense_key
from tillhouse.session import materialize


def progressed(status: str = "status") -> Column:
    """Orders past the checkout; an order without a status does not count."""
    return F.col(status) != "placed"


# --- dimensions -----------------------------------------------------------------------------------


def date_spine(days: DataFrame) -> DataFrame:
    """Calendar rows for a one-column DataFrame of dates named ``full_date``."""
    d = F.col("full_date")
    iso_day = F.weekday(d) + 1
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_day.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        iso_day.isin(6, 7).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Calendar from ``start`` to ``end``, both included."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day"))
    return date_spine(_days(bounds))


def calendar_bounds(views: Mapping[str, DataFrame]) -> tuple[str, str]:
    """First and last day of the staged orders, snapshots and events; one row per table reaches the driver."""
    days = {"orders": F.col("order_date"), "inventory": F.col("inventory_date"), "events": F.col("event_timestamp").cast("date")}
    ends = [views[t].agg(F.min(d).cast("string"), F.max(d).cast("string")).first() for t, d in days.items()]
    lows, highs = [e[0] for e in ends if e[0]], [e[1] for e in ends if e[1]]
    if not lows:
        raise ValueError("no dated rows, so no calendar")
    return min(lows), max(highs)


def outside_calendar(views: Mapping[str, DataFrame], dates: DataFrame) -> DataFrame:
    """(table_name, undated, outside): rows of the staged tables without a day, and with one that the calendar does not have."""
    first, last = dates.agg(F.min("full_date"), F.max("full_date")).first()
    days = {"orders": F.col("order_date"), "inventory": F.col("inventory_date"), "events": F.col("event_timestamp").cast("date")}
    parts = [
        views[t].agg(F.count_if(d.isNull()).alias("undated"), F.count_if(~d.between(F.lit(first), F.lit(last))).alias("outside")).select(F.lit(t).alias("table_name"), "*")
        for t, d in days.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def dim_date_of(df: DataFrame, column: str) -> DataFrame:
    """Calendar that covers every date of a table."""
    return date_spine(_days(df.agg(F.min(column).alias("first_day"), F.max(column).alias("last_day"))))


def _days(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence("first_day", "last_day", F.make_dt_interval(F.lit(1)))).alias("full_date"))


def dim_geography(spark: SparkSession) -> DataFrame:
    """Single placeholder row: addresses are gone after masking."""
    return spark.sql("SELECT * FROM VALUES (1, 'Unknown — address masked for privacy') AS g(geography_key, geography_name)")


def customer_rows(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with their order totals. Orders are summed per customer before the join."""
    totals = (
        orders.where(progressed())
        .groupBy("customer_id")
        .agg(F.count("*").alias("total_orders"), F.sum("order_amount").alias("total_spent"))
    )
    return customers.join(totals, "customer_id", "left").select(
        "customer_id", "hashed_email", "tier", "registration_date",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("total_spent", F.lit(0).cast("decimal(22,2)")).alias("total_spent"),
    )


def product_rows(products: DataFrame) -> DataFrame:
    price, cost = F.col("unit_price"), F.col("cost_price")
    margin = F.round(F.try_divide(price - cost, price) * 100, 2)  # null for a price of 0
    return products.select(
        "product_id", "product_name", "category", "subcategory", "unit_price", "cost_price",
        margin.cast("decimal(14,2)").alias("margin_pct"),
        "supplier_id", "reorder_threshold", "current_stock",
    )


def dim_customers(customers: DataFrame, orders: DataFrame, path: str | None = None) -> DataFrame:
    return dense_key(customer_rows(customers, orders), ["customer_id"], "customer_key", path=path)


def dim_products(products: DataFrame, path: str | None = None) -> DataFrame:
    return dense_key(product_rows(products), ["product_id"], "product_key", path=path)


# --- facts ----------------------------------------------------------------------------------------


def _with_date_key(df: DataFrame, day: Column, dates: DataFrame) -> DataFrame:
    """Left lookup of the calendar, which grows only with days and is always small enough to send."""
    return df.join(F.broadcast(dates.select("date_key")), date_key(day) == F.col("date_key"), "left")


def _with_key(df: DataFrame, dim: DataFrame, natural: str, key: str) -> DataFrame:
    """Left lookup of a surrogate key. Spark sends the dimension only if it measures it as small."""
    return df.join(dim.select(natural, key), natural, "left")


def order_fact_rows(orders: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    linked = _with_date_key(orders, F.col("order_date"), dates)
    linked = _with_key(linked, products, "product_id", "product_key")
    linked = _with_key(linked, customers, "customer_id", "customer_key")
    return linked.select(
        "order_id", "customer_key", "product_key", "date_key",
        F.lit(1).alias("geography_key"),
        "quantity", "unit_price", "order_amount", "status", "card_type",
        (F.col("status") == "returned").alias("is_returned"),
    )


def fact_orders(orders: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame, path: str | None = None) -> DataFrame:
    return dense_key(order_fact_rows(orders, customers, products, dates), ["order_id"], "order_key", path=path)


def event_fact_rows(events: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    linked = _with_date_key(events, F.col("event_timestamp"), dates)
    linked = _with_key(linked, products, "product_id", "product_key")
    linked = _with_key(linked, customers, "customer_id", "customer_key")
    return linked.select(
        "event_id", "event_type", "event_timestamp", "customer_key", "product_key", "date_key", "order_id",
        "order_amount", "quantity", "status",
    )


def fact_events(events: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame, path: str | None = None) -> DataFrame:
    rows = event_fact_rows(events, customers, products, dates)
    return dense_key(rows, ["event_timestamp", "event_id"], "event_key", path=path)


def inventory_velocity(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Units sold per product and day over the span of all dated orders; orders still placed sell nothing.

    The orders are read once: they are reduced to one stored row per product, and both the units and the
    span come from there.
    """
    calendar = F.broadcast(dates.select("full_date"))
    per_product = (
        orders.join(calendar, F.col("order_date") == F.col("full_date"), "left")
        .groupBy("product_id")
        .agg(
            F.count_if(progressed()).alias("sales"),
            F.sum(F.when(progressed(), F.col("quantity"))).alias("units_sold"),
            F.min("full_date").alias("first_day"),
            F.max("full_date").alias("last_day"),
        )
    )
    stored = materialize(per_product, "velocity")
    days = stored.select(F.datediff(F.max("last_day"), F.min("first_day")) + 1).scalar()
    sold = stored.where("sales > 0").select("product_id", "units_sold", days.alias("total_days"))
    return sold.withColumn("avg_daily_units_sold", F.col("units_sold") / F.col("total_days"))


def stock_status(inventory: DataFrame, velocity: DataFrame) -> DataFrame:
    """Snapshots with the reorder flag and the days the stock lasts at the product's sales rate."""
    units, days, stock = F.col("v.units_sold"), F.col("v.total_days"), F.col("i.stock_level")
    lasting = F.round(stock.cast("decimal(20,0)") * days / units.cast("decimal(20,0)"), 1)
    rate = velocity.select("product_id", "units_sold", "total_days")
    return inventory.alias("i").join(rate.alias("v"), "product_id", "left").select(
        "i.*",
        (stock < F.col("i.reorder_threshold")).alias("is_below_reorder"),
        F.when(units > 0, lasting).cast("decimal(20,1)").alias("days_of_stock_remaining"),
    )


def inventory_fact_rows(inventory: DataFrame, velocity: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    linked = _with_date_key(stock_status(inventory, velocity), F.col("inventory_date"), dates)
    known = products.select("product_id", "product_key")
    return linked.join(known, "product_id", "left").select(
        "product_id", "product_key", "date_key", "stock_level", "reorder_threshold", "units_sold", "units_received",
        "is_below_reorder",
        F.when(F.col("product_key").isNotNull(), F.col("days_of_stock_remaining")).alias("days_of_stock_remaining"),
    )


def fact_inventory_snapshots(
    inventory: DataFrame, velocity: DataFrame, products: DataFrame, dates: DataFrame, path: str | None = None
) -> DataFrame:
    rows = inventory_fact_rows(inventory, velocity, products, dates)
    return dense_key(rows, ["product_id", "date_key"], "snapshot_key", leave_out=["product_id"], path=path)


# --- backfills ------------------------------------------------------------------------------------


def backfill_customer_stats(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Replace the stored totals of every customer by those of all its orders."""
    totals = orders.groupBy("customer_id").agg(F.count("*").alias("n"), F.sum("order_amount").alias("spent"))
    joined = customers.drop("total_orders", "total_spent").join(totals, "customer_id", "left")
    return joined.withColumns(
        {
            "total_orders": F.coalesce("n", F.lit(0)),
            "total_spent": F.round(F.coalesce("spent", F.lit(0).cast("decimal(22,2)")), 2),
        }
    ).drop("n", "spent")


def backfill_current_stock(products: DataFrame, inventory: DataFrame) -> DataFrame:
    """Set the product's stock to that of its last snapshot; products without one keep their own."""
    last = inventory.groupBy("product_id").agg(F.max_by("stock_level", "date").alias("last_stock"))
    joined = products.join(last, "product_id", "left")
    return joined.withColumn("current_stock", F.coalesce("last_stock", "current_stock")).drop("last_stock")
