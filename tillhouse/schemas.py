"""Schemas and domain values of the retail tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Event types, order statuses, customer tiers, alert levels, run states.
EVENT_TYPES = (
    "customer_registered",
    "item_added_to_cart",
    "order_placed",
    "payment_processed",
    "order_shipped",
    "order_delivered",
    "order_returned",
    "inventory_updated",
)
ORDER_STATUSES = ("placed", "paid", "shipped", "delivered", "returned")
CUSTOMER_TIERS = ("bronze", "silver", "gold")
ALERT_LEVELS = ("red", "yellow", "green")
RUN_STATES = ("running", "success", "failed")

MONEY = T.DecimalType(12, 2)


_KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def table(**columns: str) -> T.StructType:
    """``table(order_id="string", quantity="int")`` as a nullable StructType, without a session."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in columns.items()])


def strings(*names: str) -> T.StructType:
    return table(**{name: "string" for name in names})


# Column names and types on the wire and in the tables.
# Bronze: stream envelope (JSON keeps its numbers) and batch drops (CSV is text only).
EVENT = table(
    event_id="string",
    event_type="string",
    event_timestamp="string",
    order_id="string",
    customer_id="string",
    customer_name="string",
    customer_email="string",
    customer_phone="string",
    product_id="string",
    product_name="string",
    category="string",
    quantity="int",
    unit_price="double",
    order_amount="double",
    shipping_address="string",
    card_last4="string",
    card_type="string",
    status="string",
    stock_level="int",
    reorder_threshold="int",
)

BRONZE_CSV = {
    "customers": strings(
        "customer_id", "customer_name", "customer_email", "customer_phone", "shipping_address",
        "registration_date", "tier", "total_orders", "total_spent",
    ),
    "products": strings(
        "product_id", "product_name", "category", "subcategory", "unit_price", "cost_price",
        "supplier_id", "reorder_threshold", "current_stock",
    ),
    "orders": strings(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "order_amount",
        "order_date", "status", "shipping_address", "card_last4", "card_type",
    ),
    "inventory": strings(
        "inventory_id", "product_id", "date", "stock_level", "reorder_threshold", "units_sold",
        "units_received",
    ),
}

# Audit tables.
RUN_LOG = table(
    run_id="string",
    stage="string",
    triggered_by="string",
    start_time="timestamp",
    end_time="timestamp",
    records_processed="bigint",
    records_failed="bigint",
    tables_failed="int",
    quality_passed="boolean",
    pii_events_masked="bigint",
    status="string",
)
PII_LOG = table(
    record_id="string",
    event_id="string",
    field_name="string",
    masking_action="string",
    original_length="int",
    pipeline_run_id="string",
    masked_at="timestamp",
)
VALIDATION_LOG = table(
    pipeline_run_id="string",
    checkpoint_name="string",
    suite_name="string",
    success="boolean",
    evaluated_expectations="bigint",
    successful_expectations="bigint",
    unsuccessful_expectations="bigint",
    run_time="timestamp",
    result_detail="string",
)
