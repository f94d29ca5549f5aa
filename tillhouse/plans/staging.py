"""Silver to staging tables (warehouse names) and the views the star schema reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.exprs import money


def _optional(df: DataFrame, name: str, kind: str):
    """The column if the table has it, otherwise a typed null."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)


# --- staging tables -------------------------------------------------------------------------------


def stage_events(silver: DataFrame) -> DataFrame:
    return silver.select(
        "event_id", "event_type", "event_timestamp", "customer_id", "order_id", "product_id", "quantity",
        money("order_amount").alias("order_amount"),
        _optional(silver, "status", "string"),
    )


def stage_customers(silver: DataFrame) -> DataFrame:
    """Totals are left out: the dimension derives them from the orders."""
    return silver.select(
        "customer_id",
        F.col("customer_name").alias("full_name"),
        F.col("hashed_email").alias("email_hash"),
        F.col("customer_phone").alias("phone_masked"),
        F.col("tier").alias("customer_tier"),
        F.col("registration_date").cast("timestamp").alias("registered_at"),
    )


def stage_products(silver: DataFrame) -> DataFrame:
    """The catalog has no stock-keeping code, so the product id serves as one."""
    return silver.select(
        "product_id",
        F.col("product_id").alias("sku"),
        "product_name",
        "category",
        money("unit_price").alias("unit_price"),
        money("cost_price").alias("cost_price"),
        F.col("reorder_threshold").alias("reorder_point"),
        _optional(silver, "subcategory", "string"),
        _optional(silver, "supplier_id", "string"),
        _optional(silver, "current_stock", "int"),
    )


def stage_orders(silver: DataFrame) -> DataFrame:
    """One line per order, so the order id is also the line id."""
    return silver.select(
        "order_id",
        F.col("order_id").alias("order_line_id"),
        "customer_id",
        "product_id",
        "quantity",
        money("unit_price").alias("unit_price"),
        money("order_amount").alias("order_amount"),
        F.col("order_date").cast("timestamp").alias("order_date"),
        F.col("status").alias("order_status"),
        _optional(silver, "card_last4", "string"),
        _optional(silver, "card_type", "string"),
    )


def stage_inventory(silver: DataFrame) -> DataFrame:
    return silver.select(
        F.col("date").alias("snapshot_date"),
        "product_id",
        F.col("stock_level").alias("quantity_on_hand"),
        F.col("reorder_threshold").alias("reorder_point"),
        F.lit("UNKNOWN").alias("warehouse_region"),
        _optional(silver, "units_sold", "int"),
        _optional(silver, "units_received", "int"),
    )


STAGE = {
    "events": stage_events,
    "customers": stage_customers,
    "products": stage_products,
    "orders": stage_orders,
    "inventory": stage_inventory,
}


# --- views over the staging tables ----------------------------------------------------------------


def stg_events(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("event_id").isNotNull()).select(
        "event_id", "event_type", "event_timestamp", "order_id", "customer_id", "product_id", "quantity",
        "order_amount", "status",
    )


def stg_customers(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        F.col("email_hash").alias("hashed_email"),
        F.col("customer_tier").alias("tier"),
        F.col("registered_at").cast("date").alias("registration_date"),
        F.col("full_name").alias("masked_customer_name"),
        F.col("phone_masked").alias("masked_customer_phone"),
    )


def stg_products(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("product_id").isNotNull()).select(
        "product_id", "product_name", "category", "subcategory", "unit_price", "cost_price", "supplier_id",
        F.col("reorder_point").alias("reorder_threshold"),
        "current_stock",
    )


def stg_orders(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("order_id").isNotNull()).select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "order_amount",
        F.col("order_date").cast("date").alias("order_date"),
        F.col("order_status").alias("status"),
        "card_last4", "card_type",
    )


def stg_inventory(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("product_id").isNotNull() & F.col("snapshot_date").isNotNull()).select(
        "product_id",
        F.col("snapshot_date").alias("inventory_date"),
        F.col("quantity_on_hand").alias("stock_level"),
        F.col("reorder_point").alias("reorder_threshold"),
        "units_sold", "units_received",
    )


VIEW = {
    "events": stg_events,
    "customers": stg_customers,
    "products": stg_products,
    "orders": stg_orders,
    "inventory": stg_inventory,
}
