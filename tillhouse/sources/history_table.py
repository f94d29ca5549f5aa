"""A history table (type 2) that a snapshot changes only where something changed.

Open versions lie in buckets by a hash of the key, each bucket in a folder of its own; every row carries a digest of its checked
columns. A snapshot compares keys and digests, opens the buckets that hold a difference, and writes them anew. The
versions it closes are appended as one more folder. Closed versions and all other buckets stay as they are, file by file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.operators.history import apply_snapshot, empty_history
from tillhouse.sources import versions
from tillhouse.sources.files import Files
from tillhouse.sources.versions import Version

BUCKETS = 64  # so many that one holds some 100 MB of open versions
_CLOSED = -1


def row_digest(columns: Sequence[str]) -> Column:
    """Digest of the checked columns; a null differs from every value."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _differing(opened: DataFrame, fresh: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets with a key that is new, gone, or has another digest. Reads two columns; at most ``buckets`` rows come back."""
    both = opened.select(key, F.col("_digest").alias("_old")).join(fresh.select(key, F.col("_digest").alias("_new")), key, "full_outer")
    differs = both.where(~F.equal_null("_old", "_new")).select(bucket_of(key, buckets).alias("bucket")).distinct()
    return sorted(r["bucket"] for r in differs.collect())


def snapshot(current: DataFrame, root: str, key: str, check_columns: Sequence[str], at: Column | str, buckets: int = BUCKETS) -> list[int]:
    """Bring the history at ``root`` up to ``current`` (one row per key) at time ``at``; returns the buckets that were opened.

    The first snapshot fixes the number of buckets. Without a difference no version is committed. When another writer
    commits meanwhile, the comparison is made again with its version.
    """
    spark = current.sparkSession
    files = Files(spark, root)
    touched: list[int] = []

    def change(base: Version | None) -> Version | None:
        n = base.notes["buckets"] if base else buckets
        shape = empty_history(current).withColumn("_digest", F.lit(""))
        fresh = current.withColumn("_digest", row_digest(check_columns))
        open_paths: dict[str, str] = dict(base.notes["open"]) if base else {}
        closed: list[str] = list(base.notes["closed"]) if base else []
        history = versions.read(spark, root, base, list(open_paths.values())) if base else shape
        touched[:] = _differing(history, fresh, key, n)
        if not touched:
            return None
        here = F.col("_bucket").isin(touched)
        some = fresh.withColumn("_bucket", bucket_of(key, n)).where(here).drop("_bucket")
        old = [open_paths[str(b)] for b in touched if str(b) in open_paths]
        opened = versions.read(spark, root, base, old) if base and old else shape
        # the digest travels as a column of the rows; a version that stays keeps the one it was opened with, which is the same
        done = apply_snapshot(opened, some, key, check_columns, at).select(*shape.columns)
        part = F.when(F.col("is_current"), bucket_of(key, n)).otherwise(F.lit(_CLOSED))
        folder = versions.write_folder(done.withColumn("part", part).repartition("part"), root, ["part"])
        written = {e.name.removeprefix("part="): e.path for e in files.list(folder) if e.is_folder}
        if str(_CLOSED) in written:
            closed.append(written.pop(str(_CLOSED)))
        for b in map(str, touched):
            open_paths.pop(b, None)
        open_paths |= written
        notes = {"buckets": n, "open": open_paths, "closed": closed}
        return Version(0, [*open_paths.values(), *closed], done.schema.json(), ["_digest"], notes)

    versions.update(spark, root, change)
    return touched


def read_history(spark: SparkSession, root: str) -> DataFrame | None:
    """All versions, or None before the first snapshot."""
    return versions.read_version(spark, root)


def read_open(spark: SparkSession, root: str) -> DataFrame | None:
    """The open versions only; closed files are not listed."""
    base = versions.current(spark, root)
    return None if base is None else versions.read(spark, root, base, list(base.notes["open"].values())).drop(*base.hidden)
