"""Slowly changing dimension history (type 2) on plain Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to", "is_current")


def empty_history(current: DataFrame) -> DataFrame:
    """A history without versions, with the columns of ``current``."""
    no_time = F.lit(None).cast("timestamp")
    return current.select(
        "*", F.lit("").alias("scd_id"), no_time.alias("updated_at"), no_time.alias("valid_from"),
        no_time.alias("valid_to"), F.lit(True).alias("is_current"),
    ).limit(0)


def apply_snapshot(
    history: DataFrame, current: DataFrame, key: str, check_columns: Sequence[str], at: Column | str
) -> DataFrame:
    """The history after seeing ``current`` (one row per key) at time ``at``.

    A new key opens a version. A change in a check column (null counts as a value) closes the open version
    and opens another. A key that is gone has its version closed. Otherwise the open version stays as it
    is, its other columns included. Only open versions are joined; closed ones pass through.
    """
    time = (F.lit(at) if isinstance(at, str) else at).cast("timestamp")
    attributes = current.columns
    opened = history.where("is_current")
    closed = history.where("NOT is_current")

    old = opened.select(F.col(key), F.struct(*history.columns).alias("old"))
    new = current.select(F.col(key), F.struct(*attributes).alias("new"))
    pairs = old.join(new, key, "full_outer")

    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = F.lit(False)
    for c in check_columns:
        changed = changed | ~F.equal_null(F.col(f"old.{c}"), F.col(f"new.{c}"))
    ends = ~has_new | changed

    def version(**values: Column) -> Column:
        return F.struct(*[values.get(c, F.lit(None)).cast(history.schema[c].dataType).alias(c) for c in history.columns])

    kept = {c: F.col(f"old.{c}") for c in history.columns}
    kept["valid_to"] = F.when(ends, time)
    kept["updated_at"] = F.when(ends, time).otherwise(F.col("old.updated_at"))
    kept["is_current"] = ~ends
    fresh = {c: F.col(f"new.{c}") for c in attributes}
    fresh |= {
        "scd_id": F.md5(F.concat_ws("|", F.col(f"new.{key}"), F.date_format(time, "yyyy-MM-dd HH:mm:ss"))),
        "updated_at": time,
        "valid_from": time,
        "is_current": F.lit(True),
    }
    versions = F.array(
        F.when(has_old, version(**kept)),
        F.when(has_new & (~has_old | changed), version(**fresh)),
    )
    rewritten = pairs.select(F.inline(F.filter(versions, lambda v: v.isNotNull())))
    return closed.unionByName(rewritten)
