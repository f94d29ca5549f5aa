"""Batch drops that are loaded once, whatever stops in between.

A load goes through three steps: a data folder of its own, the marker of a finished write in it, and a ledger row that names
the folder. Only the row makes the drop count. It is a file that is created if it is absent, so of two loaders of one
drop one succeeds. After a stop before the row, the next run loads the drop again, and the folder without a row is swept.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillhouse.sources.files import Files

LEDGER = "drop_id string, entity string, folder string, files bigint, bytes bigint, run_id string, loaded_at timestamp"
_SAFE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def _row(entity: str, drop_id: str) -> str:
    for name in (entity, drop_id):
        if not _SAFE.fullmatch(name):
            raise ValueError(f"not a name for a folder: {name!r}")
    return f"ledger/{entity}/{drop_id}.json"


def is_loaded(files: Files, entity: str, drop_id: str) -> bool:
    return files.exists(_row(entity, drop_id))


def load_drop(df: DataFrame, root: str, entity: str, drop_id: str, run_id: str = "") -> bool:
    """Load one drop; False when the ledger lists it already or another loader was faster."""
    files = Files(df.sparkSession, root)
    if is_loaded(files, entity, drop_id):
        return False
    folder = f"data/{entity}/{drop_id}.{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{files.root}/{folder}")
    return _enter(files, entity, drop_id, folder, run_id)


def _enter(files: Files, entity: str, drop_id: str, folder: str, run_id: str) -> bool:
    if not files.exists(f"{folder}/_SUCCESS"):
        raise RuntimeError(f"{folder} has no marker of a finished write")
    n, size = files.content(folder)
    row = {"drop_id": drop_id, "entity": entity, "folder": folder, "files": n, "bytes": size, "run_id": run_id}
    row["loaded_at"] = datetime.now(timezone.utc).isoformat()
    if files.create_new(_row(entity, drop_id), json.dumps(row) + "\n"):
        return True
    files.delete(folder)
    return False


def load_drops(root: str, entity: str, drops: Mapping[str, DataFrame], run_id: str = "") -> list[str]:
    """Load the drops that the ledger does not list; returns their ids."""
    return [drop_id for drop_id, df in drops.items() if load_drop(df, root, entity, drop_id, run_id)]


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per loaded drop."""
    files = Files(spark, root)
    entities = [e.path for e in files.list("ledger") if e.is_folder]
    if not entities:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).json([f"{files.root}/{p}" for p in entities])


def loaded(spark: SparkSession, root: str, entity: str, schema: StructType) -> DataFrame:
    """The rows of all drops of an entity that the ledger lists."""
    files = Files(spark, root)
    folders = [json.loads(files.read(e.path))["folder"] for e in files.list(f"ledger/{entity}") if e.name.endswith(".json")]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{files.root}/{f}" for f in folders])


def sweep(spark: SparkSession, root: str, older_than_hours: float = 24.0) -> list[str]:
    """Remove data folders that no ledger row names and that are too old to belong to a running load."""
    files = Files(spark, root)
    limit = datetime.now(timezone.utc).timestamp() * 1000 - older_than_hours * 3_600_000
    removed = []
    for entity in files.list("data"):
        named = {json.loads(files.read(e.path))["folder"] for e in files.list(f"ledger/{entity.name}") if e.name.endswith(".json")}
        for folder in files.list(entity.path):
            if folder.path not in named and folder.changed_ms <= limit:
                files.delete(folder.path)
                removed.append(folder.path)
    return removed
