"""Keyed upsert that touches only the listed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_by_key(table: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """New version of ``table``.

    A known key takes ``columns`` from the update, null included, and keeps the rest. An unknown key is
    inserted with every column the update has. ``updates`` holds one row per key.
    """
    keys = list(keys)
    flagged = updates.withColumn("_update", F.lit(True))
    old, new = table.withColumn("_row", F.lit(True)).alias("old"), flagged.alias("new")
    joined = old.join(new, keys, "full_outer")

    def value(c: str):
        kind = table.schema[c].dataType
        if c in keys:
            return F.col(c)
        if c not in updates.columns:
            return F.col(f"old.{c}")
        insert = F.col("old._row").isNull()
        if c in columns:
            return F.when(F.col("new._update"), F.col(f"new.{c}").cast(kind)).otherwise(F.col(f"old.{c}")).alias(c)
        return F.when(insert, F.col(f"new.{c}").cast(kind)).otherwise(F.col(f"old.{c}")).alias(c)

    return joined.select(*[value(c).alias(c) for c in table.columns])
