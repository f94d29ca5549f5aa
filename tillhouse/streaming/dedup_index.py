"""Deduplication on a stream against a stored index of keys.

Keys that were seen lie in files by day and micro-batch. A micro-batch reads the days around its own events, drops what is there,
and adds its new keys. No operator state is kept, however long the stream runs; memory is that of one batch. Old days of the
index leave by retention. A batch that runs again overwrites what it wrote and does not see its own keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from tillhouse.operators.dedup import keep_first
from tillhouse.sources.readers import read_or_empty

KEYS = ("event_id", "event_type")
AROUND_DAYS = 1  # copies whose event days are further apart count as different events
NO_DAY = "1970-01-01"  # rows without a time


def _index_schema(batch: DataFrame, keys: Sequence[str]) -> StructType:
    return StructType([batch.schema[k] for k in keys]).add("day", "date").add("batch", LongType())


def new_rows(batch: DataFrame, batch_id: int, index: str, keys: Sequence[str] = KEYS, time: str = "event_timestamp", around_days: int = AROUND_DAYS) -> DataFrame:
    """First rows of the batch whose key no earlier batch had on the days around."""
    spark = batch.sparkSession
    ties = [F.col(c) for c in batch.columns if c not in keys and c != time]
    first = keep_first(batch.withColumn("day", _day(time)), keys, [F.col(time).asc_nulls_last(), *ties])
    # a few dates reach the driver, so that the days of the index are pruned by folder names
    days = [r["day"] for r in first.select("day").distinct().collect()]
    near = sorted({F_day for d in days for F_day in _around(d, around_days)})
    schema = _index_schema(batch, keys)
    seen = read_or_empty(spark, schema, lambda: spark.read.schema(schema).parquet(index))
    seen = seen.where(F.col("day").isin(near) & (F.col("batch") < batch_id)).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("day").alias("_day"))
    same = F.abs(F.datediff("_day", "day")) <= around_days
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return first.join(seen, same, "left_anti")


def _around(day, days: int):
    from datetime import timedelta

    return [day + timedelta(days=n) for n in range(-days, days + 1)]


def _day(time: str):
    return F.coalesce(F.col(time).cast("date"), F.lit(NO_DAY).cast("date"))


def stream_dedup(events: DataFrame, out: str, index: str, checkpoint: str, keys: Sequence[str] = KEYS, time: str = "event_timestamp",
                 around_days: int = AROUND_DAYS, bounded: bool = False, seconds: int = 15) -> StreamingQuery:
    """Write the first arrival of each key below ``out``; keys go to ``index``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        here = new_rows(batch, batch_id, index, keys, time, around_days).withColumn("batch", F.lit(batch_id).cast("long"))
        here.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(out)
        written = batch.sparkSession.read.parquet(out) if _any(out, batch.sparkSession) else None
        if written is not None:  # the rows as written, so both hold the same ones
            mine = written.where(F.col("batch") == batch_id).select(*keys, "day", "batch")
            mine.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(index)

    trigger = {"availableNow": True} if bounded else {"processingTime": f"{seconds} seconds"}
    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _any(path: str, spark: SparkSession) -> bool:
    from tillhouse.sources.files import Files

    return any(e.is_folder and "=" in e.name for e in Files(spark, path).list())


def deduplicated(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The rows written so far."""
    return read_or_empty(spark, schema, lambda: spark.read.schema(schema).parquet(out)).select(*schema.fieldNames())
