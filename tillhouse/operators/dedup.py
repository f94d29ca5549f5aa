"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row of every key group in ``order_by``.

    Spark plans a rank limit below the shuffle, so each map task sends at most one row per key and a
    key that holds a large part of the table does not pile up in one reducer. ``order_by`` should end
    with tie-break columns, otherwise the winner among equals may change between runs.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedup_events(events: DataFrame) -> DataFrame:
    """Earliest copy of each (event_id, event_type); a missing timestamp sorts first and wins."""
    keys = ["event_id", "event_type"]
    ties = [c for c in ("order_id", "customer_id", "product_id", "order_amount", "quantity") if c in events.columns]
    return keep_first(events, keys, [F.col("event_timestamp").asc_nulls_first(), *ties])


def dedup_latest(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Newest row per key by ``version``; the rest of the row breaks ties."""
    rest = [c for c in df.columns if c not in keys and c != version]
    return keep_first(df, keys, [F.col(version).desc_nulls_last(), *rest])
