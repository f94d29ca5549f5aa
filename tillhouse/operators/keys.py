"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.session import scratch_path
from tillhouse.sources.keyed import write_keyed


def dense_key(df: DataFrame, order_by: Sequence[str], key: str, leave_out: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Number the rows 1..n in ``order_by`` without sorting the table in one task.

    The rows are range-partitioned, sorted in parallel and written once, to ``path`` where the table is to stay or else to a scratch
    folder; a row's number follows from its file and its place there. Stored rows cannot move when a task runs again.
    """
    return write_keyed(df, path or scratch_path(df.sparkSession, key), order_by, key, leave_out)


def hash_key(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Key that stays the same across rebuilds: 64-bit hash of the natural key."""
    return df.select(F.xxhash64(*columns).alias(key), "*")
