"""Tables whose dense key follows from where a row is stored, so that the table is written once.

The rows are range-partitioned by the key's order, sorted, and written; files in the order of their names then hold the rows in
that order. A side file says with which number each data file starts, and a row's key is that number plus its
place in its file. Nothing is written a second time, and the key needs no column.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.sources.files import Files

OFFSETS = "_keys.json"


def write_keyed(df: DataFrame, path: str, order_by: Sequence[str], key: str, leave_out: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once in ``order_by`` and return it with its rows numbered 1..n in column ``key``.

    A hash of the other columns ends the order, so a value that repeats very often lies in several files. Columns to
    ``leave_out`` serve the order only.
    """
    spark = df.sparkSession
    rest = [c for c in df.columns if c not in order_by]
    order = [*order_by, F.xxhash64(*rest)] if rest else list(order_by)
    files = Files(spark, path)
    if files.exists(OFFSETS):
        files.delete(OFFSETS)  # from now on the old numbers do not count
    df.repartitionByRange(*order).sortWithinPartitions(*order).drop(*leave_out).write.mode("overwrite").parquet(path)
    _number(spark, path, key)
    return read_keyed(spark, path)


def _number(spark: SparkSession, path: str, key: str) -> dict:
    """Count the rows of each file (footers only) and write the side file."""
    stored = spark.read.parquet(path)
    counts = {r["f"]: r["n"] for r in stored.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count("*").alias("n")).collect()}
    starts, at = {}, 0
    for name in sorted(counts):
        starts[name] = at
        at += counts[name]
    side = {"key": key, "rows": at, "starts": starts}
    Files(spark, path).create_new(OFFSETS, json.dumps(side))
    return side


def read_keyed(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """The table with its key first. Without a side file (a stop right after the write) ``key`` names the key, and it is made anew."""
    files = Files(spark, path)
    if files.exists(OFFSETS):
        side = json.loads(files.read(OFFSETS))
    elif key:
        side = _number(spark, path, key)
    else:
        raise RuntimeError(f"{path} has no {OFFSETS}")
    stored = spark.read.parquet(path)
    # one row per data file, whose number the shuffle settings bound
    starts = spark.createDataFrame(sorted(side["starts"].items()) or [("", 0)], "_file string, _start long")
    placed = stored.select("*", F.col("_metadata.file_name").alias("_name"), F.col("_metadata.row_index").alias("_at"))
    numbered = placed.join(F.broadcast(starts), F.col("_name") == F.col("_file"))
    return numbered.select((F.col("_start") + F.col("_at") + 1).alias(side["key"]), *stored.columns)
