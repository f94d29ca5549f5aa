"""The bucketed history: equal to the plain operator, and closed files stay."""

from __future__ import annotations

import os
import random

from pyspark.sql import functions as F

from collected import rows
from tillhouse.operators import history
from tillhouse.sources import history_table, versions

CHECKS = ("tier", "spent")
SCHEMA = "customer_id string, name string, tier string, spent decimal(12,2)"


def listing(root):
    """Every data file with its size and time of change."""
    out = {}
    for folder, _, names in os.walk(root):
        for n in names:
            if n.endswith(".parquet"):
                s = os.stat(os.path.join(folder, n))
                out[os.path.relpath(os.path.join(folder, n), root)] = (s.st_size, s.st_mtime_ns)
    return out


def test_only_touched_buckets_are_written(spark, tmp_path, frame):
    root = str(tmp_path / "h")
    people = [(f"c{i}", "n", "gold", None) for i in range(200)]
    assert len(history_table.snapshot(frame(SCHEMA, *people), root, "customer_id", CHECKS, "2024-01-01", buckets=16)) == 16
    first = listing(root)
    # nothing differs: no commit, no file
    assert history_table.snapshot(frame(SCHEMA, *people), root, "customer_id", CHECKS, "2024-01-02") == []
    assert listing(root) == first and versions.current(spark, root).number == 1
    # one changes, and its bucket alone is written; the closed version is one more file
    people[7] = ("c7", "n", "silver", None)
    touched = history_table.snapshot(frame(SCHEMA, *people), root, "customer_id", CHECKS, "2024-01-03")
    assert len(touched) == 1
    second = listing(root)
    assert first.items() <= second.items()  # not one old file was changed
    new = set(second) - set(first)
    assert len(new) == 2 and {n.split("/")[1] for n in new} == {"part=-1", f"part={touched[0]}"}
    people[7] = ("c7", "n", "bronze", None)
    del people[3]
    history_table.snapshot(frame(SCHEMA, *people), root, "customer_id", CHECKS, "2024-01-04")
    third = listing(root)
    closed = [n for n in new if "part=-1" in n]
    assert all(third[n] == second[n] for n in closed)
    got = history_table.read_history(spark, root)
    assert rows(got.where("customer_id IN ('c7', 'c3')"), "customer_id", "tier", "is_current") == [
        ("c3", "gold", False), ("c7", "bronze", True), ("c7", "gold", False), ("c7", "silver", False)
    ]
    assert got.columns == history.empty_history(frame(SCHEMA)).columns
    assert history_table.read_open(spark, root).count() == 199
    # old folders go once no version names them, but closed versions are always named
    for n in range(5):
        people[19] = ("c20", "n", f"t{n}", None)  # one place lower since c3 is gone
        history_table.snapshot(frame(SCHEMA, *people), root, "customer_id", CHECKS, f"2024-02-0{n + 1}")
    assert all(listing(root)[n] == second[n] for n in closed)
    assert history_table.read_history(spark, root).count() == 199 + 3 + 5


def test_equal_to_the_plain_operator_over_random_changes(spark, tmp_path):
    rng, root, plain = random.Random(5), str(tmp_path / "h"), None
    people = {f"c{i}": ("gold", 1) for i in range(40)}
    for step in range(6):
        for _ in range(rng.choice([0, 1, 5, 30])):
            who = f"c{rng.randrange(60)}"
            if rng.random() < 0.3:
                people.pop(who, None)
            else:
                people[who] = (rng.choice(["gold", "silver", None]), rng.choice([1, 2, None]))
        current = spark.createDataFrame([(k, "n", t, s) for k, (t, s) in people.items()], "customer_id string, name string, tier string, spent int")
        at = f"2024-0{step + 1}-01"
        plain = history.apply_snapshot(history.empty_history(current) if plain is None else plain, current, "customer_id", CHECKS, at)
        plain = spark.createDataFrame(plain.collect(), plain.schema)
        history_table.snapshot(current, root, "customer_id", CHECKS, at, buckets=8)
        stored = history_table.read_history(spark, root)
        assert rows(stored.fillna("-")) == rows(plain.fillna("-"))


def test_empty_snapshots(spark, tmp_path, frame):
    root = str(tmp_path / "h")
    assert history_table.read_history(spark, root) is None and history_table.read_open(spark, root) is None
    assert history_table.snapshot(frame(SCHEMA), root, "customer_id", CHECKS, "2024-01-01") == []
    assert history_table.snapshot(frame(SCHEMA, ("a", "n", "gold", None)), root, "customer_id", CHECKS, "2024-01-02", buckets=4) != []
    history_table.snapshot(frame(SCHEMA), root, "customer_id", CHECKS, "2024-01-03")
    assert history_table.read_open(spark, root).count() == 0 and rows(history_table.read_history(spark, root), "customer_id", "is_current") == [("a", False)]


def test_another_writer_between_reading_and_commit(spark, tmp_path, frame, monkeypatch):
    root = str(tmp_path / "h")
    old, new = ("a", "n", "gold", None), ("a", "n", "silver", None)
    history_table.snapshot(frame(SCHEMA, old), root, "customer_id", CHECKS, "2024-01-01", buckets=4)
    real, calls = history_table._differing, []

    def interrupted(*args):
        calls.append(1)
        if len(calls) == 1:
            history_table.snapshot(frame(SCHEMA, new), root, "customer_id", CHECKS, "2024-01-02")
        return real(*args)

    monkeypatch.setattr(history_table, "_differing", interrupted)
    history_table.snapshot(frame(SCHEMA, new, ("b", "n", "gold", None)), root, "customer_id", CHECKS, "2024-01-03")
    got = history_table.read_history(spark, root).select("customer_id", "tier", F.date_format("valid_from", "dd").alias("d"))
    assert rows(got) == [("a", "gold", "01"), ("a", "silver", "02"), ("b", "gold", "03")]
