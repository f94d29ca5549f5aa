"""Bronze text to typed Silver columns, null-key filters, and the counts that go with them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.dedup import dedup_events
from tillhouse.schemas import CUSTOMER_TIERS


@dataclass(frozen=True)
class SilverSpec:
    """What turns one Bronze table into its Silver table."""

    casts: Mapping[str, str]
    domains: Mapping[str, Sequence[str]] = field(default_factory=dict)
    required: Sequence[str] = ()


# Target types, allowed values and required columns per table.
SPECS = {
    "events": SilverSpec(
        casts={"event_timestamp": "timestamp", "quantity": "int", "unit_price": "double", "order_amount": "double"},
        required=("event_id", "order_id", "customer_id"),
    ),
    "customers": SilverSpec(
        casts={"registration_date": "date", "total_spent": "double", "total_orders": "int"},
        domains={"tier": CUSTOMER_TIERS},
    ),
    "products": SilverSpec(
        casts={"unit_price": "double", "cost_price": "double", "reorder_threshold": "int", "current_stock": "int"},
        required=("product_id",),
    ),
    "orders": SilverSpec(
        casts={"order_date": "date", "order_amount": "double", "unit_price": "double", "quantity": "int"},
    ),
    "inventory": SilverSpec(
        casts={"date": "date", "stock_level": "int", "reorder_threshold": "int", "units_sold": "int", "units_received": "int"},
        required=("product_id", "date"),
    ),
}


def conformed(name: str, kind: str) -> Column:
    """Typed column; a malformed value becomes null and is counted by ``cast_failures``."""
    c = F.col(name)
    if kind == "timestamp":
        return F.try_to_timestamp(c)
    return c.try_cast(kind)


def conform(df: DataFrame, spec: SilverSpec) -> DataFrame:
    """Apply the casts and turn values outside a domain into null. Drops no row."""
    changes = {c: conformed(c, kind) for c, kind in spec.casts.items() if c in df.columns}
    for c, allowed in spec.domains.items():
        changes[c] = F.when(F.col(c).isin(*allowed), F.col(c))
    return df.withColumns(changes)


def has_keys(spec: SilverSpec) -> Column:
    test = F.lit(True)
    for c in spec.required:
        test = test & F.col(c).isNotNull()
    return test


def silver_events(bronze: DataFrame, ingestion_date: str | Column) -> DataFrame:
    """Typed, deduplicated events that carry all their keys; PII is still in the clear.

    Rows without an event_id cannot survive, so they leave before the shuffle instead of meeting in
    one dedup group. The other keys are tested on the winning copy only.
    """
    spec = SPECS["events"]
    day = F.lit(ingestion_date) if isinstance(ingestion_date, str) else ingestion_date
    typed = conform(bronze, spec).where(F.col("event_id").isNotNull())
    return dedup_events(typed).where(has_keys(spec)).withColumn("ingestion_date", day.cast("date"))


def silver_table(bronze: DataFrame, name: str) -> DataFrame:
    """Typed batch table without rows that miss a required key."""
    spec = SPECS[name]
    return conform(bronze, spec).where(has_keys(spec))


def _failed_casts(columns: Sequence[str], name: str) -> dict[str, Column]:
    """Per column: a value is there in Bronze that does not survive the cast or the domain."""
    spec = SPECS[name]
    results = {c: conformed(c, kind) for c, kind in spec.casts.items() if c in columns}
    results |= {c: F.when(F.col(c).isin(*allowed), F.col(c)) for c, allowed in spec.domains.items()}
    return {c: F.col(c).isNotNull() & typed.isNull() for c, typed in results.items()}


def failed_columns(columns: Sequence[str], name: str) -> list[str]:
    return list(_failed_casts(columns, name))


def cast_failures(bronze: DataFrame, name: str) -> DataFrame:
    """(column_name, failures): values present in Bronze that did not survive the cast or the domain."""
    failed = _failed_casts(bronze.columns, name)
    counted = bronze.agg(*[F.count_if(bad).alias(c) for c, bad in failed.items()])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in failed]
    return counted.select(F.inline(F.array(*rows)))


def intake_counts(bronze: DataFrame, name: str) -> list[Column]:
    """Aggregates over Bronze rows: ``rows_in``, ``keyed`` (rows with all required keys) and ``failed_<column>``."""
    spec, keyed = SPECS[name], F.lit(True)
    for c in spec.required:
        keyed = keyed & (conformed(c, spec.casts[c]) if c in spec.casts else F.col(c)).isNotNull()
    failed = [F.count_if(bad).alias(f"failed_{c}") for c, bad in _failed_casts(bronze.columns, name).items()]
    return [F.count("*").alias("rows_in"), F.count_if(keyed).alias("keyed"), *failed]


def event_drop_counts(bronze: DataFrame) -> DataFrame:
    """One row: rows in, rows without event_id, repeated copies, winners without a key, rows out."""
    spec = SPECS["events"]
    typed = conform(bronze, spec)
    zero = F.lit(0).cast("bigint")
    intake = typed.agg(F.count("*").alias("rows_in"), F.count_if(F.col("event_id").isNull()).alias("missing_event_id"))
    winners = dedup_events(typed.where(F.col("event_id").isNotNull()))
    kept = winners.agg(F.count("*").alias("distinct_events"), F.count_if(has_keys(spec)).alias("rows_out"))
    both = intake.select("*", zero.alias("distinct_events"), zero.alias("rows_out")).unionByName(
        kept.select("*", zero.alias("rows_in"), zero.alias("missing_event_id"))
    )
    total = both.agg(*[F.sum(c).alias(c) for c in both.columns])
    return total.select(
        F.lit("events").alias("table_name"),
        "rows_in",
        "missing_event_id",
        (F.col("rows_in") - F.col("missing_event_id") - F.col("distinct_events")).alias("repeated_copies"),
        (F.col("distinct_events") - F.col("rows_out")).alias("missing_key"),
        "rows_out",
    )


def table_drop_counts(bronze: DataFrame, name: str) -> DataFrame:
    """Same columns as ``event_drop_counts`` for a batch table, in one pass."""
    spec = SPECS[name]
    kept = F.count_if(has_keys(spec))
    return conform(bronze, spec).agg(F.count("*").alias("rows_in"), kept.alias("rows_out")).select(
        F.lit(name).alias("table_name"),
        "rows_in",
        F.lit(0).cast("bigint").alias("missing_event_id"),
        F.lit(0).cast("bigint").alias("repeated_copies"),
        (F.col("rows_in") - F.col("rows_out")).alias("missing_key"),
        "rows_out",
    )
