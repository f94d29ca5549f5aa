"""Readers of the Bronze and Silver layers."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType

from tillhouse.schemas import BRONZE_CSV, EVENT

log = logging.getLogger(__name__)


def read_or_empty(spark: SparkSession, schema: StructType, load: Callable[[], DataFrame]) -> DataFrame:
    """The loaded table, or an empty one of that schema when its path does not exist or holds no file.

    A partitioned table without rows is a folder without files. Every other failure is raised.
    """
    try:
        return load()
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        log.warning("no input: %s", problem.getMessage())
        return spark.createDataFrame([], schema)


def read_bronze_events(spark: SparkSession, root: str, day: str, event_types: Sequence[str] = ()) -> DataFrame:
    """One day's events over all event types. The day and type filters prune directories."""
    # event_type comes from the directory name, so the column is not read twice
    file_schema = StructType([f for f in EVENT.fields if f.name != "event_type"])
    partitions = StructType(file_schema.fields).add("event_type", StringType()).add("date", DateType())
    stored = read_or_empty(spark, partitions, lambda: spark.read.schema(partitions).json(root))
    rows = stored.where(F.col("date") == F.lit(day).cast("date"))
    if event_types:
        rows = rows.where(F.col("event_type").isin(*event_types))
    return rows.select(*EVENT.fieldNames())


def read_bronze_csv(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """A batch drop with a header row; every column stays text."""
    return read_csv_folder(spark, f"{root}/batch/{entity}", entity)


def read_csv_folder(spark: SparkSession, path: str, entity: str) -> DataFrame:
    schema = BRONZE_CSV[entity]
    return read_or_empty(
        spark, schema, lambda: spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    )


def read_silver(spark: SparkSession, root: str, table: str, schema: StructType | None = None, **partition: str) -> DataFrame:
    """A Silver table, optionally one of its partitions, with the partition columns restored."""
    base = f"{root}/{table}"
    path = "/".join([base, *[f"{name}={value}" for name, value in partition.items()]])
    reader = spark.read.option("basePath", base)
    if schema is None:
        return reader.parquet(path)
    return read_or_empty(spark, schema, lambda: reader.schema(schema).parquet(path))


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, partitions: int, **options: str) -> DataFrame:
    """A relational table read in parallel key ranges. The driver jar and the database come from outside."""
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high, numPartitions=partitions, properties=options)


def table_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)
