"""Versioned tables: commits, conflicts between writers, and what is removed."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F

from collected import rows
from tillhouse.sources import versions, writers
from tillhouse.sources.files import Files

SCHEMA = "id string, a int, b int"


def test_a_name_is_given_once(spark, tmp_path):
    files, won = Files(spark, str(tmp_path)), []

    def take(i):
        if files.create_new("sub/name.json", f"content {i}"):
            won.append(i)

    threads = [threading.Thread(target=take, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and files.read("sub/name.json") == f"content {won[0]}"
    assert [e.name for e in files.list("sub") if not e.name.endswith(".crc")] == ["name.json"]


def test_rename_does_not_replace(spark, tmp_path):
    """The way taken on other file systems than the local one."""
    files = Files(spark, str(tmp_path))
    assert files.create_new("a", "1") and files.create_new("b", "2")
    with pytest.raises(FileExistsError):
        files.rename_new("b", "a")
    files.rename_new("b", "c")
    assert files.read("a") == "1" and files.read("c") == "2" and not files.exists("b")


def test_interleaved_upserts_keep_both(spark, tmp_path, frame, monkeypatch):
    """The second writer reads, the first commits, the second tries: it has to change again on top of the first's version."""
    root = str(tmp_path / "log")
    writers.upsert_table(frame(SCHEMA, ("x", 1, 1), ("y", 1, 1)), root, ["id"], ["a"])
    real, calls = versions.write_folder, []

    def slow(df, at, partition_by=()):
        calls.append(at)
        folder = real(df, at, partition_by)
        if len(calls) == 1:  # between this writer's read and its commit
            writers.upsert_table(frame(SCHEMA, ("y", 7, 7), ("z", 3, 3)), root, ["id"], ["a"])
        return folder

    monkeypatch.setattr(versions, "write_folder", slow)
    writers.upsert_table(frame(SCHEMA, ("x", 5, 5)), root, ["id"], ["a"])
    assert rows(versions.read_version(spark, root)) == [("x", 5, 1), ("y", 7, 1), ("z", 3, 3)]
    assert len(calls) == 3 and versions.current(spark, root).number == 3


def test_many_writers_at_once(spark, tmp_path, frame):
    root = str(tmp_path / "log")
    updates = [frame(SCHEMA, (f"w{i}", i, i), ("all", i, i)) for i in range(5)]
    threads = [threading.Thread(target=writers.upsert_table, args=(u, root, ["id"], ["a"])) for u in updates]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = versions.read_version(spark, root)
    assert sorted(r["id"] for r in got.collect()) == ["all", "w0", "w1", "w2", "w3", "w4"]
    assert versions.current(spark, root).number == 5
    folders = [p for p in os.listdir(root) if p.startswith("v")]
    assert len(folders) == versions.KEEP_VERSIONS  # lost attempts have left nothing behind


def test_a_commit_that_stops_half_way_is_not_seen(spark, tmp_path, frame, monkeypatch):
    root = str(tmp_path / "t")
    versions.write_version(frame(SCHEMA, ("x", 1, 1)), root)
    real = Files.create_new
    monkeypatch.setattr(Files, "create_new", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError, match="stopped"):
        versions.write_version(frame(SCHEMA, ("x", 2, 2)), root)
    monkeypatch.setattr(Files, "create_new", real)
    assert rows(versions.read_version(spark, root)) == [("x", 1, 1)]
    versions.write_version(frame(SCHEMA, ("x", 3, 3)), root)
    assert rows(versions.read_version(spark, root)) == [("x", 3, 3)]


def test_a_late_writer_cannot_take_a_number_again(spark, tmp_path, frame):
    """Commit files stay for ever, so a writer that slept through many versions gets a conflict."""
    root = str(tmp_path / "t")
    for n in range(7):
        versions.write_version(frame(SCHEMA, ("x", n, n)), root, keep=1)
    files = Files(spark, root)
    assert not files.create_new("_commit-000000000002.json", "{}")
    assert len([e for e in files.list() if e.is_folder]) == 1
    with pytest.raises(ValueError):
        versions.write_version(frame(SCHEMA, ("x", 1, 1)), root, keep=0)


def test_a_change_that_fails_is_raised_and_nothing_changes(spark, tmp_path, frame):
    root = str(tmp_path / "t")
    versions.write_version(frame(SCHEMA, ("x", 1, 1)), root)

    def change(base):
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        versions.update(spark, root, change)
    assert versions.update(spark, root, lambda base: None).number == 1
    breaks = frame(SCHEMA, ("x", 1, 1)).withColumn("a", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        writers.upsert_table(breaks, root, ["id"], ["a"])
    assert rows(versions.read_version(spark, root)) == [("x", 1, 1)]
