"""The configured expectation suites, the freshness rule, and the gate in front of the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.operators.expectations import (
    Suite,
    between,
    exists,
    in_set,
    matches,
    not_null,
    result_detail,
    row_count_between,
    run_suite,
    summarize,
    unique,
)
from tillhouse.schemas import CUSTOMER_TIERS, EVENT_TYPES
from tillhouse.sources.files import Files

# Suite parameters.
HEX_DIGEST = "^[a-f0-9]{64}$"
AMOUNT = (0.01, 50000)
QUANTITY = (1, 1000)
FRESHNESS_HOURS = 2
SOURCE_WARN_HOURS = 3
SOURCE_ERROR_HOURS = 6

SUITES = {
    "events": Suite(
        "silver_events",
        "checkpoint_silver_events",
        (
            *map(exists, ("event_id", "event_type", "event_timestamp", "order_id", "customer_id", "product_id",
                          "order_amount", "quantity", "ingestion_date")),
            *map(not_null, ("event_id", "event_type", "event_timestamp", "order_id", "customer_id")),
            in_set("event_type", *EVENT_TYPES),
            between("order_amount", *AMOUNT),
            between("quantity", *QUANTITY),
            unique("event_id"),
            matches("hashed_email", HEX_DIGEST),
            row_count_between(1),
        ),
    ),
    "customers": Suite(
        "silver_customers",
        "checkpoint_silver_customers",
        (
            *map(not_null, ("customer_id", "tier", "registration_date")),
            unique("customer_id"),
            in_set("tier", *CUSTOMER_TIERS),
            between("total_spent", 0, 1_000_000),
            not_null("hashed_email"),
            matches("hashed_email", HEX_DIGEST),
        ),
    ),
    "orders": Suite(
        "silver_orders",
        "checkpoint_silver_orders",
        (
            *map(not_null, ("order_id", "customer_id", "product_id", "order_date", "order_amount")),
            unique("order_id"),
            between("order_amount", *AMOUNT),
            between("quantity", *QUANTITY),
        ),
    ),
    "inventory": Suite(
        "silver_inventory",
        "checkpoint_silver_inventory",
        (
            *map(not_null, ("product_id", "date", "stock_level")),
            between("stock_level", 0, 1_000_000),
            between("units_sold", 0, 100_000),
        ),
    ),
    "products": Suite(
        "silver_products",
        "checkpoint_silver_products",
        (not_null("product_id"), unique("product_id"), not_null("product_name"), not_null("category")),
    ),
}
GATED_TABLES = ("events", "customers", "orders", "inventory")
FRESHNESS_CHECKPOINT = "checkpoint_silver_freshness"
FRESHNESS_SUITE = "silver_freshness"


class GateFailed(RuntimeError):
    """A checkpoint failed, so nothing downstream may run."""


def run_checkpoints(silver: Mapping[str, DataFrame], tables: Sequence[str] = GATED_TABLES) -> DataFrame:
    """Rule results of every configured checkpoint."""
    return reduce(DataFrame.unionByName, [run_suite(silver[t], SUITES[t]) for t in tables])


def freshness_check(events: DataFrame, reference_now: Column, max_hours: int = FRESHNESS_HOURS) -> DataFrame:
    """One row: age of the newest event against the limit; exactly the limit still passes.

    ``reference_now`` is the clock pinned to the run's logical day. Without any timestamp the check fails.
    """
    if "event_timestamp" not in events.columns:
        newest = events.agg(F.lit(None).cast("timestamp").alias("most_recent"), F.count("*").alias("n"))
        nothing = "event_timestamp column missing"
    else:
        newest = events.agg(F.max("event_timestamp").alias("most_recent"), F.count("*").alias("n"))
        nothing = "all event timestamps are null"
    # microseconds, so that one millisecond beyond the limit already fails
    late = F.unix_micros(reference_now.cast("timestamp")) - F.unix_micros("most_recent")
    fresh = F.coalesce(late <= max_hours * 3_600_000_000, F.lit(False))
    reason = (
        F.when(F.col("n") == 0, "no rows")
        .when(F.col("most_recent").isNull(), nothing)
        .when(fresh, "fresh")
        .otherwise(f"older than {max_hours} h")
    )
    return newest.select(
        F.lit(FRESHNESS_CHECKPOINT).alias("checkpoint_name"),
        F.lit(FRESHNESS_SUITE).alias("suite_name"),
        fresh.alias("success"),
        "most_recent",
        # completed seconds on either side of the clock, without a detour through a double
        F.call_function("div", late, F.lit(1_000_000)).alias("age_seconds"),
        reason.alias("reason"),
    )


def pinned_now(run_date: str) -> Column:
    """The current time of day on the run's logical day."""
    return F.try_to_timestamp(F.concat(F.lit(f"{run_date} "), F.date_format(F.current_timestamp(), "HH:mm:ss.SSSSSS")))


def freshness_summary(check: DataFrame) -> DataFrame:
    """The freshness row in the shape of a checkpoint summary."""
    ok = F.col("success").cast("bigint")
    return check.select(
        "checkpoint_name", "suite_name",
        F.lit(1).cast("bigint").alias("evaluated_expectations"),
        ok.alias("successful_expectations"),
        (1 - ok).alias("unsuccessful_expectations"),
        "success",
    )


def source_freshness(
    staged: Mapping[str, DataFrame], now: Column, loaded_at: str = "_silver_loaded_at",
    warn_hours: int = SOURCE_WARN_HOURS, error_hours: int = SOURCE_ERROR_HOURS,
) -> DataFrame:
    """(table_name, max_loaded_at, age_seconds, state) with state pass, warn or error per table."""
    parts = []
    for name, df in staged.items():
        parts.append(df.agg(F.max(loaded_at).cast("timestamp").alias("max_loaded_at")).select(F.lit(name).alias("table_name"), "max_loaded_at"))
    return _freshness(reduce(DataFrame.unionByName, parts), now, warn_hours, error_hours)


def file_freshness(
    spark: SparkSession, paths: Mapping[str, str], now: Column, warn_hours: int = SOURCE_WARN_HOURS, error_hours: int = SOURCE_ERROR_HOURS
) -> DataFrame:
    """``source_freshness`` from the times at which the tables' files were written: no column is read, no job runs.

    A table without files has no load time, which is an error.
    """
    rows = [(name, newest_file(Files(spark, path))) for name, path in paths.items()]
    return _freshness(spark.createDataFrame(rows, "table_name string, max_loaded_at timestamp"), now, warn_hours, error_hours)


def newest_file(files: Files) -> datetime | None:
    """When the newest data file of a table was written; side files and hidden ones do not count."""
    newest, open_ = None, [""]
    while open_:
        for e in files.list(open_.pop()):
            if e.name.startswith((".", "_")):
                continue
            if e.is_folder:
                open_.append(e.path)
            else:
                newest = max(newest or 0, e.changed_ms)
    return None if newest is None else datetime.fromtimestamp(newest / 1000, timezone.utc)


def _freshness(loaded: DataFrame, now: Column, warn_hours: int, error_hours: int) -> DataFrame:
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds("max_loaded_at")
    state = (
        F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > error_hours * 3600), "error")
        .when(F.col("age_seconds") > warn_hours * 3600, "warn")
        .otherwise("pass")
    )
    return loaded.withColumn("age_seconds", age).withColumn("state", state)


def checkpoint_summary(results: DataFrame, freshness: DataFrame | None = None) -> DataFrame:
    """(checkpoint_name, suite_name, evaluated, successful, unsuccessful, success) per checkpoint."""
    table = summarize(results)
    return table if freshness is None else table.unionByName(freshness_summary(freshness))


def validation_rows(results: DataFrame, run_id: str, freshness: DataFrame | None = None) -> DataFrame:
    """Rows for the validation log, with the rule results as JSON."""
    rows = summarize(results).join(result_detail(results), "checkpoint_name")
    if freshness is not None:
        detail = freshness.select("checkpoint_name", F.to_json(F.struct("reason", "age_seconds")).alias("result_detail"))
        rows = rows.unionByName(freshness_summary(freshness).join(detail, "checkpoint_name"))
    return rows.select(
        F.lit(run_id).alias("pipeline_run_id"),
        "checkpoint_name", "suite_name", "success",
        "evaluated_expectations", "successful_expectations", "unsuccessful_expectations",
        F.current_timestamp().alias("run_time"),
        "result_detail",
    )


def quality_gate(summary: DataFrame) -> None:
    """Raise ``GateFailed`` when any checkpoint failed. Reads one row per failed checkpoint."""
    failed = [r["checkpoint_name"] for r in summary.where(~F.col("success")).select("checkpoint_name").collect()]
    if failed:
        raise GateFailed("failed checkpoints: " + ", ".join(sorted(failed)))
