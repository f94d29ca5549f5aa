"""Retention on partitioned folders: what is too old is found by folder names and removed without reading a row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import SparkSession

from tillhouse.sources.files import Files
from tillhouse.sources.writers import upsert_table

KEEP_DAYS = 7
RETENTION_LOG = "run_id string, folder string, day date, files bigint, bytes bigint, found_at timestamp, removed_at timestamp"


@dataclass(frozen=True)
class Expired:
    folder: str
    day: date
    files: int
    bytes: int


def expired_folders(spark: SparkSession, root: str, run_date: str, keep_days: int = KEEP_DAYS, key: str = "date") -> list[Expired]:
    """Folders ``key=<day>`` at any depth whose day lies more than ``keep_days`` before the run date.

    Levels above are partition folders too (``name=value``); other folders and days that are no dates are left alone.
    """
    files, limit, found = Files(spark, root), date.fromisoformat(run_date) - timedelta(days=keep_days), []
    open_ = [""]
    while open_:
        for e in files.list(open_.pop()):
            name, _, value = e.name.partition("=")
            if not e.is_folder or not value:
                continue
            if name != key:
                open_.append(e.path)
                continue
            try:
                day = date.fromisoformat(value)
            except ValueError:
                continue
            if day < limit:
                found.append(Expired(e.path, day, *files.content(e.path)))
    return sorted(found, key=lambda x: x.folder)


def remove_expired(
    spark: SparkSession, root: str, run_date: str, log_root: str, run_id: str, keep_days: int = KEEP_DAYS, key: str = "date"
) -> Sequence[Expired]:
    """Remove the expired folders, with a log of what went.

    The log says what was found before anything goes, and when it went afterwards. A run that stopped in between
    finds the rest again; the rows of what had gone stay.
    """
    found = expired_folders(spark, root, run_date, keep_days, key)
    if not found:
        return found
    now = datetime.now(timezone.utc)
    rows = [(run_id, x.folder, x.day, x.files, x.bytes, now, None) for x in found]
    keys, log = ["run_id", "folder"], spark.createDataFrame(rows, RETENTION_LOG)
    upsert_table(log, log_root, keys, ["found_at"])
    files = Files(spark, root)
    for x in found:
        files.delete(x.folder)
    gone = datetime.now(timezone.utc)
    upsert_table(spark.createDataFrame([(*r[:6], gone) for r in rows], RETENTION_LOG), log_root, keys, ["removed_at"])
    return found
