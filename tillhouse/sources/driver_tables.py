"""Retail tables derived from the given star-schema Parquet tables.

Every function is a lazy DataFrame over the whole input. Money is exact decimal from the first step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillhouse.functions.exprs import money, month_start
from tillhouse.operators.dedup import keep_first
from tillhouse.session import configure

# Which given event type plays which retail event.
EVENT_ROLES = {
    "signup": "customer_registered",
    "view": "item_added_to_cart",
    "purchase": "order_placed",
    "click": "payment_processed",
    "error": "order_returned",
}
EVENT_STATUS = {
    "customer_registered": "joined",
    "item_added_to_cart": "basket",
    "order_placed": "placed",
    "payment_processed": "paid",
    "order_returned": "returned",
}
CARD_TYPES = ("Visa", "Mastercard", "Amex")
RETAIL_TABLES = ("customer", "part", "orders", "lineitem", "events")


_SCHEMAS: dict[str, StructType] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the file footer once per process, not at every use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = configure(spark).read.parquet(path).schema
    return configure(spark).read.schema(_SCHEMAS[path]).parquet(path)


def _id(prefix: str, c: str) -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.col(c).cast("string"))


def _choice(values: dict[str, str], c: Column) -> Column:
    out = F.lit(None).cast("string")
    for given, role in values.items():
        out = F.when(c == given, role).otherwise(out)
    return out


def _card(c: str) -> list[Column]:
    return [
        F.lpad((F.col(c) % 10000).cast("string"), 4, "0").alias("card_last4"),
        F.element_at(F.array(*map(F.lit, CARD_TYPES)), (F.col(c) % 3 + 1).cast("int")).alias("card_type"),
    ]


def _address(c: str) -> Column:
    """Street address; every fifth one also names a person."""
    street = F.concat((F.col(c) % 9000 + 100).cast("string"), F.lit(" Main St, Springfield, IL "),
                      F.lpad((F.col(c) % 100000).cast("string"), 5, "0"))
    return F.when(F.col(c) % 5 == 0, F.concat(F.lit("c/o Dr. Lee, "), street)).otherwise(street)


def _person(c: str, name: Column) -> list[Column]:
    return [
        name.alias("customer_name"),
        F.concat(F.lit(" User."), F.col(c).cast("string"), F.lit("@Example.com ")).alias("customer_email"),
        F.concat(F.lit("+1202"), F.lpad(F.col(c).cast("string"), F.greatest(F.lit(7), F.length(F.col(c).cast("string"))), F.lit("0"))).alias("customer_phone"),
    ]


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per (order, line number); the given table repeats some of these pairs."""
    return keep_first(
        read(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"],
    )


def _order_status() -> Column:
    return (
        F.when(F.col("l_returnflag") == "R", "returned")
        .when(F.col("o_orderstatus") == "O", "placed")
        .when((F.col("o_orderstatus") == "P") & (F.col("l_linestatus") == "O"), "paid")
        .when(F.col("o_orderstatus") == "P", "shipped")
        .otherwise("delivered")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail orders: one row per order line, single product."""
    parts = read(spark, sf_dir, "part").select("p_partkey", money("p_retailprice").alias("unit_price"))
    heads = read(spark, sf_dir, "orders")
    lines = order_lines(spark, sf_dir)
    joined = lines.join(heads, lines["l_orderkey"] == heads["o_orderkey"])
    joined = joined.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.concat_ws("-", F.lit("ORD"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_id"),
        _id("CUST", "o_custkey").alias("customer_id"),
        _id("PROD", "l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        "unit_price",
        money("l_extendedprice").alias("order_amount"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        _order_status().alias("status"),
        _address("o_custkey").alias("shipping_address"),
        *_card("l_orderkey"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail customers; registered on the day of their first order, null without one."""
    firsts = (
        read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min(F.col("o_orderdate").cast("date")).alias("registration_date"))
    )
    base = read(spark, sf_dir, "customer")
    tier = (
        F.when(F.col("c_acctbal") >= 7500, "gold").when(F.col("c_acctbal") >= 4000, "silver")
        .when(F.col("c_acctbal") < 0, "unrated").otherwise("bronze")
    )
    joined = base.join(firsts, base["c_custkey"] == firsts["o_custkey"], "left")
    return joined.select(
        _id("CUST", "c_custkey").alias("customer_id"),
        *_person("c_custkey", F.col("c_name")),
        _address("c_custkey").alias("shipping_address"),
        "registration_date",
        tier.alias("tier"),
        F.lit(0).alias("total_orders"),
        F.lit(0).cast("decimal(12,2)").alias("total_spent"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = money("p_retailprice")
    return read(spark, sf_dir, "part").select(
        _id("PROD", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        price.alias("unit_price"),
        money(F.round(price * (35 + F.col("p_size") % 31) / 100, 2)).alias("cost_price"),
        F.concat(F.lit("SUPP-"), (F.col("p_partkey") % 100).cast("string")).alias("supplier_id"),
        F.col("p_size").alias("reorder_threshold"),
        (F.col("p_size") * 10).alias("current_stock"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot per product and month of shipping. Sums first, looks the product up after."""
    lines = read(spark, sf_dir, "lineitem")
    by_flag = lambda test: F.coalesce(F.sum(F.when(test, F.col("l_quantity"))), F.lit(0)).cast("int")
    monthly = lines.groupBy("l_partkey", month_start("l_shipdate").alias("date")).agg(
        by_flag(F.col("l_linestatus") == "O").alias("stock_level"),
        by_flag(F.col("l_linestatus") == "F").alias("units_sold"),
        by_flag(F.col("l_returnflag") == "R").alias("units_received"),
    )
    parts = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("reorder_threshold"))
    return monthly.join(parts, monthly["l_partkey"] == parts["p_partkey"]).select(
        F.concat_ws("-", F.lit("INV"), F.col("l_partkey").cast("string"), F.date_format("date", "yyyyMM")).alias("inventory_id"),
        _id("PROD", "l_partkey").alias("product_id"),
        "date", "stock_level", "reorder_threshold", "units_sold", "units_received",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze envelopes of the given events."""
    return envelopes(read(spark, sf_dir, "events"))


def envelopes(given: DataFrame) -> DataFrame:
    """Events as delivered at least once: every seventh comes twice. Works on a stream as well."""
    copies = F.when(F.col("event_id") % 7 == 0, F.array(F.lit(5), F.lit(0))).otherwise(F.array(F.lit(0)))
    stamped = given.withColumn("delay", F.explode(copies)).withColumn("role", _choice(EVENT_ROLES, F.col("event_type")))
    at = F.col("ts").cast("timestamp") + F.make_dt_interval(secs=F.col("delay"))
    registered = F.col("role") == "customer_registered"
    ordering = lambda c: F.when(~registered, c)
    item = F.get_json_object("props", "$.k").try_cast("int")
    return stamped.select(
        F.concat(F.lit("EVT-"), F.col("event_id").cast("string")).alias("event_id"),
        F.col("role").alias("event_type"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_timestamp"),
        ordering(_id("ORD", "event_id")).alias("order_id"),
        _id("CUST", "user_id").alias("customer_id"),
        *_person("user_id", F.concat(F.lit("Customer "), F.col("user_id").cast("string"))),
        ordering(F.concat(F.lit("PROD-"), item.cast("string"))).alias("product_id"),
        F.lit(None).cast("string").alias("product_name"),
        F.lit(None).cast("string").alias("category"),
        ordering(item).alias("quantity"),
        F.lit(None).cast("double").alias("unit_price"),
        ordering(F.col("value")).alias("order_amount"),
        F.when(F.col("role") == "order_placed", _address("user_id")).alias("shipping_address"),
        *_card("event_id"),
        _choice(EVENT_STATUS, F.col("role")).alias("status"),
        F.lit(None).cast("int").alias("stock_level"),
        F.lit(None).cast("int").alias("reorder_threshold"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> tuple[str | None, str | None]:
    """First and last day of the orders and the inventory snapshots."""
    ends = lambda table, c: read(spark, sf_dir, table).agg(F.min(c).cast("date").alias("first"), F.max(c).cast("date").alias("last"))
    stocked = ends("lineitem", "l_shipdate").select(month_start("first").alias("first"), month_start("last").alias("last"))
    both = ends("orders", "o_orderdate").unionByName(stocked).agg(F.min("first").cast("string"), F.max("last").cast("string")).first()
    return both[0], both[1]


def messages(envelope: DataFrame) -> DataFrame:
    """The envelopes as JSON text in ``value``."""
    return envelope.select(F.to_json(F.struct(*envelope.columns), {"ignoreNullFields": "false"}).alias("value"))


def as_bronze(df: DataFrame) -> DataFrame:
    """The table as a text drop: every column a string."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
