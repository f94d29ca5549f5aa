"""The declared table tests of the staging views, dimensions, facts and marts."""

from __future__ import annotations

from collections.abc import Iterable

from tillhouse.schemas import ALERT_LEVELS, CUSTOMER_TIERS, EVENT_TYPES, ORDER_STATUSES

# Which columns must be set, unique, within a list, or known to another table.
REQUIRED = {
    "stg_events": ("event_id", "event_type", "customer_id"),
    "stg_customers": ("customer_id", "tier"),
    "stg_products": ("product_id", "product_name", "category"),
    "stg_orders": ("order_id", "customer_id", "product_id", "order_amount"),
    "stg_inventory": ("product_id", "inventory_date", "stock_level"),
    "dim_customers": ("customer_key", "customer_id"),
    "dim_products": ("product_key", "product_id"),
    "dim_date": ("date_key", "full_date"),
    "fact_orders": ("order_key", "order_id", "customer_key", "product_key", "date_key"),
    "fact_inventory_snapshots": ("snapshot_key", "product_key", "date_key"),
    "fact_events": ("event_key", "event_id"),
    "mart_sales_summary": ("period_date", "category"),
    "mart_inventory_alerts": ("product_id",),
    "mart_return_rates": ("product_id", "period_date"),
    "mart_customer_cohorts": ("cohort_week", "weeks_since_acquisition"),
}
UNIQUE = {
    "stg_events": ("event_id",),
    "stg_customers": ("customer_id",),
    "stg_products": ("product_id",),
    "stg_orders": ("order_id",),
    "dim_customers": ("customer_key", "customer_id"),
    "dim_products": ("product_key", "product_id"),
    "dim_date": ("date_key",),
    "fact_orders": ("order_key",),
    "fact_inventory_snapshots": ("snapshot_key",),
    "fact_events": ("event_key", "event_id"),
    "mart_inventory_alerts": ("product_id",),
}
ACCEPTED = {
    "stg_events": {"event_type": EVENT_TYPES},
    "stg_customers": {"tier": CUSTOMER_TIERS},
    "stg_orders": {"status": ORDER_STATUSES},
    "dim_customers": {"tier": CUSTOMER_TIERS},
    "dim_date": {"day_of_week": (1, 2, 3, 4, 5, 6, 7), "quarter": (1, 2, 3, 4)},
    "mart_inventory_alerts": {"alert_level": ALERT_LEVELS},
}
REFERENCES = (
    ("fact_orders", "customer_key", "dim_customers", "customer_key"),
    ("fact_orders", "product_key", "dim_products", "product_key"),
    ("fact_orders", "date_key", "dim_date", "date_key"),
    ("fact_inventory_snapshots", "product_key", "dim_products", "product_key"),
)


def for_tables(names: Iterable[str]) -> dict:
    """The declarations that concern these tables, as arguments of ``run_table_tests``."""
    names = set(names)
    keep = lambda declared: {t: v for t, v in declared.items() if t in names}
    return {
        "required": keep(REQUIRED),
        "keys": keep(UNIQUE),
        "domains": keep(ACCEPTED),
        "references": [ref for ref in REFERENCES if ref[0] in names and ref[2] in names],
    }
