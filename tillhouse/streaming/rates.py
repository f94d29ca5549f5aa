"""Event rates on a stream.

``land_panes`` keeps counts per five-minute pane of every micro-batch; rates read from them are complete at any time, also for
the newest windows and for rows that come late, and the stream holds no state. ``compact_panes`` adds the folders of finished
batches up into one table per day, so the number of files follows the days, not the batches. The append forms emit a window once, when
the watermark has passed its end, and so leave out the newest windows and late rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillhouse.plans.ops import event_rate_1h, event_rate_5m, pane_counts, pane_rate
from tillhouse.sources import versions
from tillhouse.sources.files import Files
from tillhouse.sources.readers import read_or_empty
from tillhouse.sources.versions import Version
from tillhouse.streaming.bronze import LATENESS


PANE = "5 minutes"
PANES = "pane_start timestamp, event_type string, events long"
_PANE_TYPE = StructType().add("pane_start", "timestamp").add("event_type", "string").add("events", "long")


def land_panes(events: DataFrame, root: str, checkpoint: str, time: str = "event_timestamp", bounded: bool = False, seconds: int = 15) -> StreamingQuery:
    """Counts per pane and event type of every micro-batch, in a folder of its own that a repeated batch overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        pane_counts(batch, time, PANE, ("event_type",)).write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    trigger = {"availableNow": True} if bounded else {"processingTime": f"{seconds} seconds"}
    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _batches(files: Files) -> dict[int, str]:
    return {int(e.name.removeprefix("batch=")): e.path for e in files.list() if e.is_folder and e.name.startswith("batch=")}


def compact_panes(spark: SparkSession, root: str) -> int:
    """Add the batches up to the one before the newest into tables per day; returns the last batch that is in them.

    The newest batch may still run again, so it stays a folder. Only days that the new batches touch are written. The commit
    names the last batch taken in, and readers leave out folders up to it, so a stop before their removal counts nothing twice.
    """
    store, files = f"{root}/compacted", Files(spark, root)
    through = -1

    def change(base: Version | None) -> Version | None:
        nonlocal through
        through = base.notes["through"] if base else -1
        found = _batches(files)
        upto = max(found, default=-1) - 1
        fresh = [f"{files.root}/{p}" for n, p in sorted(found.items()) if through < n <= upto]
        if not fresh:
            return None
        added = spark.read.schema(PANES).parquet(*fresh).withColumn("day", F.col("pane_start").cast("date").cast("string"))
        days = dict(base.notes["days"]) if base else {}
        touched = [r["day"] for r in added.select("day").distinct().collect()]
        old = [days[d] for d in touched if d in days]
        if old:
            added = added.unionByName(versions.read(spark, store, base, old).withColumn("day", F.col("pane_start").cast("date").cast("string")))
        summed = added.groupBy("day", "pane_start", "event_type").agg(F.sum("events").alias("events"))
        folder = versions.write_folder(summed.repartition("day"), store, ["day"])
        days |= {e.name.removeprefix("day="): e.path for e in Files(spark, store).list(folder) if e.is_folder}
        through = upto
        return Version(0, list(days.values()), _PANE_TYPE.json(), [], {"through": upto, "days": days})

    versions.update(spark, store, change)
    for n, path in _batches(files).items():
        if n <= through:
            files.delete(path)
    return through


def landed_panes(spark: SparkSession, root: str) -> DataFrame:
    """Counts per pane and type of all batches, those in day tables and those that still are folders."""
    files = Files(spark, root)
    base = versions.current(spark, f"{root}/compacted") if files.exists("compacted") else None
    through = base.notes["through"] if base else -1
    open_ = [f"{files.root}/{p}" for n, p in sorted(_batches(files).items()) if n > through]
    panes = read_or_empty(spark, _PANE_TYPE, lambda: spark.read.schema(PANES).parquet(*open_)) if open_ else spark.createDataFrame([], _PANE_TYPE)
    return panes if base is None else panes.unionByName(versions.read(spark, f"{root}/compacted", base))


def landed_rate_5m(spark: SparkSession, root: str) -> DataFrame:
    return pane_rate(landed_panes(spark, root), "5 minutes", 300, ("event_type",))


def landed_rate_1h(spark: SparkSession, root: str) -> DataFrame:
    return pane_rate(landed_panes(spark, root), "1 hour", 3600, ("event_type",), slide=PANE)


def stream_event_rate_5m(events: DataFrame, time: str = "event_timestamp", lateness: str = LATENESS) -> DataFrame:
    return event_rate_5m(events.withWatermark(time, lateness), time)


def stream_event_rate_1h(events: DataFrame, time: str = "event_timestamp", lateness: str = LATENESS) -> DataFrame:
    return event_rate_1h(events.withWatermark(time, lateness), time)


def late_rows(query) -> int:
    """Rows dropped behind the watermark so far, from the query's progress reports."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])
