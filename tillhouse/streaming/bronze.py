"""Streaming ingest: messages to Bronze files, quarantine, and deduplication on the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillhouse.operators.ingest import accepted, ingest_metrics, parse_events, quarantined, with_bronze_partition

# Flush interval and lateness.
FLUSH_SECONDS = 15
LATENESS = "1 hour"


def kafka_messages(spark: SparkSession, servers: str, topic: str, flush_rows: int | None = None, **options: str) -> DataFrame:
    """Messages of a topic from its earliest offset. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", "earliest").options(**options)
    if flush_rows:
        reader = reader.option("maxOffsetsPerTrigger", flush_rows)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """One message per line of text files that appear in a folder."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def table_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """A Parquet file or folder as a stream. The pattern fits that one name, as a file source takes no plain file."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def _trigger(bounded: bool, seconds: int) -> dict:
    return {"availableNow": True} if bounded else {"processingTime": f"{seconds} seconds"}


def stream_bronze(
    messages: DataFrame, root: str, checkpoint: str, bounded: bool = False, flush_seconds: int = FLUSH_SECONDS
) -> StreamingQuery:
    """Write accepted events below ``event_type=/date=`` and rejected messages to the quarantine.

    Every micro-batch owns its folders (the last partition level is the batch number) and overwrites
    them, so a batch that runs again after a failure leaves no copies and offsets only advance after
    both writes. Counts per event type go to the metrics folder of the same batch.
    """
    parsed = with_day(parse_events(messages))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("batch", F.lit(batch_id)).persist()
        try:
            def put(df: DataFrame, name: str, kind: str, *partitions: str) -> None:
                writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy(*partitions).format(kind).save(f"{root}/{name}")

            # each folder gets one file, or as many as its size asks for, instead of one from every task
            put(accepted(batch).hint("rebalance", "event_type", "date"), "events", "json", "event_type", "date", "batch")
            put(quarantined(batch).withColumn("batch", F.lit(batch_id)), "quarantine", "json", "batch")
            put(ingest_metrics(batch).withColumn("batch", F.lit(batch_id)), "metrics", "parquet", "batch")
        finally:
            batch.unpersist()

    writer = parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(bounded, flush_seconds)).start()


def with_day(parsed: DataFrame) -> DataFrame:
    """Partition columns; the fallback day is the micro-batch's own clock, also when it runs again."""
    return with_bronze_partition(parsed)


def stream_dedup_events(events: DataFrame, time: str = "event_timestamp", lateness: str = LATENESS) -> DataFrame:
    """First arrival of each (event_id, event_type); copies further apart than ``lateness`` may pass.

    The batch job stays the authority on which copy wins.
    """
    return events.withWatermark(time, lateness).dropDuplicatesWithinWatermark(["event_id", "event_type"])


def run_bounded(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what its source holds now into a Parquet table, and return that table."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
