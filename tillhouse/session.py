"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# All of these are runtime SQL settings, so they also apply to a session somebody else built.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when that costs one more exchange afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a rerun replaces only the partitions it writes
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Wide rows in columnar files: a task's memory follows the bytes it reads, so reads and shuffled partitions are kept small, whatever
# the size of the tables. Partitions this small are joined by hash instead of sorting both sides.
TABLE_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "4m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
}
BYTES_PER_PARTITION = 4 << 20  # of stored columns; shuffled rows are a few times that


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's runtime settings to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def configure_tables(spark: SparkSession, paths: Sequence[str] = ()) -> SparkSession:
    """``configure`` for work on tables. Shuffles start with partitions in proportion to the files of ``paths``, and at least with the
    session's own number; adaptive execution joins those that turn out small."""
    configure(spark)
    for name, value in TABLE_SETTINGS.items():
        spark.conf.set(name, value)
    partitions = sum(stored_bytes(spark, path) for path in paths) // BYTES_PER_PARTITION
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if partitions > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(initial, str(partitions))
    else:
        spark.conf.unset(initial)
    return spark


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder; 0 where there is none."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillhouse")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in extra.items():
        builder = builder.config(name, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach. The cluster names it in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
    folder = tempfile.mkdtemp(prefix="tillhouse-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/tillhouse/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str, release: bool = False) -> DataFrame:
    """Write ``df`` as a shared Parquet table and read it back.

    Cuts the lineage, survives lost executors, and fixes values such as partition ids that may
    differ when a lost task is computed again. With ``release`` the shuffle files behind the table
    go as soon as it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_RELEASE, "false")
    if release:
        spark.conf.set(_RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            spark.conf.set(_RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)
