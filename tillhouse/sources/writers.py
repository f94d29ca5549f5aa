"""Writers: idempotent tables, logs, batch drops, versioned tables and retention."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.expectations import Suite, failing_examples
from tillhouse.operators.upsert import upsert_by_key
from tillhouse.sources import versions
from tillhouse.sources.versions import KEEP_VERSIONS, Version, read_version, write_version  # noqa: F401

log = logging.getLogger(__name__)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), only_present: bool = False) -> None:
    """Overwrite a Parquet table or one partition folder of it.

    ``only_present`` replaces just the partitions that occur in ``df`` and leaves the others alone.
    """
    writer = df.write.mode("overwrite").option("compression", "snappy")
    writer = writer.option("partitionOverwriteMode", "dynamic" if only_present else "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def load_staging(df: DataFrame, path: str) -> bool:
    """Replace a staging table and stamp the load time. An empty input leaves the old table alone."""
    if df.isEmpty():
        log.warning("nothing to load into %s", path)
        return False
    write_table(df.withColumn("_silver_loaded_at", F.current_timestamp()), path)
    return True


def write_run_partition(df: DataFrame, path: str, run_column: str = "pipeline_run_id") -> None:
    """Write a run's rows of a log table; a rerun replaces its own rows."""
    write_table(df, path, partition_by=[run_column], only_present=True)


write_pii_audit = write_run_partition
write_validation = write_run_partition


def write_bronze_csv(df: DataFrame, root: str, entity: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(f"{root}/batch/{entity}")


# --- versioned tables -----------------------------------------------------------------------------


def upsert_table(updates: DataFrame, root: str, keys: Sequence[str], columns: Sequence[str], like: DataFrame | None = None) -> None:
    """Upsert into a versioned table, creating it from the updates the first time.

    When two writers meet, the later one upserts again into what the earlier one committed.
    """
    spark = updates.sparkSession

    def change(base: Version | None) -> Version:
        table = (like if like is not None else updates).limit(0) if base is None else versions.read(spark, root, base)
        return Version(0, [versions.write_folder(upsert_by_key(table, updates, keys, columns), root)])

    versions.update(spark, root, change)


# --- ingest ledger and retention ------------------------------------------------------------------


def ingest_once(drops: DataFrame, ledger: DataFrame, key: str = "drop_id") -> DataFrame:
    """The batch drops that the ledger does not list yet."""
    return drops.join(ledger.select(key), key, "left_anti")


def expired(day: Column, run_date: str, keep_days: int = 7) -> Column:
    return day < F.date_sub(F.lit(run_date).cast("date"), keep_days)


def expired_partitions(df: DataFrame, run_date: str, keep_days: int = 7, day: str = "date") -> DataFrame:
    """The days that have left the retention period, with their row counts."""
    return df.where(expired(F.col(day), run_date, keep_days)).groupBy(day).agg(F.count("*").alias("rows"))


def drop_expired(df: DataFrame, run_date: str, keep_days: int = 7, day: str = "date") -> DataFrame:
    """The table without its expired days. On a partitioned table the filter prunes directories."""
    return df.where(F.col(day).isNull() | ~expired(F.col(day), run_date, keep_days))


def failed_rule_examples(df: DataFrame, suite: Suite, hidden: Sequence[str], n: int = 20) -> dict[str, list[str]]:
    """Some values behind each failed row rule for the log, at most ``n`` per rule and none of hidden columns."""
    out = {}
    for rule in suite.rules:
        if rule.kind.startswith("values_") and rule.kind not in ("values_to_be_unique", "values_to_not_be_null"):
            if rule.column in df.columns and rule.column not in hidden:
                found = [r["value"] for r in failing_examples(df, rule, n).collect()]
                if found:
                    out[f"{rule.kind}:{rule.column}"] = found
    return out
