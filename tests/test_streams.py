"""Streams that keep no state: deduplication against stored keys, pane tables, and load times of files."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from collected import rows
from tillhouse.plans import checkpoints, ops
from tillhouse.sources import driver_tables as given
from tillhouse.sources import retention
from tillhouse.streaming import bronze as streams
from tillhouse.streaming import dedup_index, rates


def timed(df):
    return given.envelopes(df).withColumn("event_timestamp", F.try_to_timestamp("event_timestamp"))


@pytest.fixture(scope="module")
def shuffled(spark, sf, tmp_path_factory):
    """The given events in eight files, and the copies of each delivered with some other file."""
    path = str(tmp_path_factory.mktemp("in") / "events")
    given.read(spark, sf, "events").repartition(8, F.xxhash64("event_id", "user_id")).write.parquet(path)
    return path


def take(spark, source, root, schema, **options):
    stream = timed(streams.table_stream(spark, source, schema, max_files=1))
    query = dedup_index.stream_dedup(stream, f"{root}/out", f"{root}/index", f"{root}/state", bounded=True, **options)
    query.awaitTermination()
    return stream.schema, query


def test_dedup_over_micro_batches_equals_batch(spark, sf, shuffled, tmp_path):
    table = given.read(spark, sf, "events")
    twice = str(tmp_path / "twice")  # every file comes twice, the second time in another order
    table.repartition(5, "user_id").write.parquet(twice)
    table.repartition(3, "event_id").write.mode("append").parquet(twice)
    schema, query = take(spark, twice, str(tmp_path), table.schema)
    assert len({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) == 8
    assert all(not p["stateOperators"] for p in query.recentProgress)  # no state at all
    got = dedup_index.deduplicated(spark, f"{tmp_path}/out", schema)
    want = timed(table).select("event_id", "event_type").distinct()
    assert rows(got.select("event_id", "event_type")) == rows(want)
    index = spark.read.parquet(f"{tmp_path}/index")
    assert index.count() == want.count()
    # nothing new: a second run changes nothing
    take(spark, twice, str(tmp_path), table.schema)
    assert dedup_index.deduplicated(spark, f"{tmp_path}/out", schema).count() == want.count()


def test_a_batch_that_runs_again_sees_only_earlier_keys(spark, tmp_path, frame):
    schema = "event_id string, event_type string, event_timestamp timestamp, n int"
    make = lambda *r: frame("event_id string, event_type string, t string, n int", *r).select("event_id", "event_type", F.to_timestamp("t").alias("event_timestamp"), "n")
    first = make(("a", "x", "2024-01-01 10:00", 1), ("a", "x", "2024-01-01 09:00", 2), ("b", "x", None, 3), ("b", "x", None, 4))
    index = str(tmp_path / "index")
    assert rows(dedup_index.new_rows(first, 0, index), "event_id", "n") == [("a", 2), ("b", 3)]
    dedup_index.new_rows(first, 0, index).withColumn("batch", F.lit(0)).select("event_id", "event_type", "day", "batch").write.partitionBy("day", "batch").parquet(index)
    assert rows(dedup_index.new_rows(first, 0, index), "event_id", "n") == [("a", 2), ("b", 3)]  # the batch again
    later = make(("a", "x", "2024-01-02 00:00", 5), ("a", "y", "2024-01-01 10:00", 6), ("b", "x", None, 7), ("a", "x", "2024-01-09 10:00", 8))
    # the copy on the next day is one; eight days on it is another event
    assert rows(dedup_index.new_rows(later.where("n <> 8"), 1, index), "event_id", "n") == [("a", 6)]
    assert rows(dedup_index.new_rows(later.where("n = 8"), 1, index), "event_id", "n") == [("a", 8)]
    assert schema.count(",") == 3


def test_old_days_of_the_index_leave(spark, sf, shuffled, tmp_path):
    take(spark, shuffled, str(tmp_path), given.read(spark, sf, "events").schema)
    before = spark.read.parquet(f"{tmp_path}/index").count()
    gone = retention.remove_expired(spark, f"{tmp_path}/index", "2024-01-20", str(tmp_path / "log"), "r", key="day")
    left = spark.read.parquet(f"{tmp_path}/index")
    assert gone and 0 < left.count() < before and left.where("day < DATE '2024-01-13' AND day > DATE '1970-01-01'").count() == 0


def test_compacted_panes_give_the_same_rates(spark, sf, shuffled, tmp_path):
    table, root = given.read(spark, sf, "events"), str(tmp_path / "panes")
    stream = timed(streams.table_stream(spark, shuffled, table.schema, max_files=1))
    rates.land_panes(stream, root, str(tmp_path / "state"), bounded=True).awaitTermination()
    want5, want60 = rows(ops.event_rate_5m(timed(table))), rows(ops.event_rate_1h(timed(table)))
    assert rows(rates.landed_rate_5m(spark, root)) == want5
    assert rates.compact_panes(spark, root) == 6  # the newest of eight batches stays a folder
    assert sorted(n for n in os.listdir(root) if n.startswith("batch=")) == ["batch=7"]
    assert rows(rates.landed_rate_5m(spark, root)) == want5 and rows(rates.landed_rate_1h(spark, root)) == want60
    files = [n for _, _, names in os.walk(f"{root}/compacted") for n in names if n.endswith(".parquet")]
    days = {str(d["d"]) for d in timed(table).select(F.to_date("event_timestamp").alias("d")).distinct().collect()}
    assert len(files) <= len(days)
    assert rates.compact_panes(spark, root) == 6 and rows(rates.landed_rate_5m(spark, root)) == want5
    # more batches for one day touch that day's table only
    one = ops.pane_counts(timed(table.limit(50)), "event_timestamp", rates.PANE, ("event_type",)).where("pane_start < TIMESTAMP '2024-01-02'")
    for n in (8, 9):
        one.write.parquet(f"{root}/batch={n}")
    before = rows(rates.landed_panes(spark, root).groupBy("event_type").agg(F.sum("events")))
    assert rates.compact_panes(spark, root) == 8
    assert rows(rates.landed_panes(spark, root).groupBy("event_type").agg(F.sum("events"))) == before


def test_a_stop_between_commit_and_removal_counts_nothing_twice(spark, sf, shuffled, tmp_path, monkeypatch):
    from tillhouse.sources.files import Files

    table, root = given.read(spark, sf, "events"), str(tmp_path / "panes")
    stream = timed(streams.table_stream(spark, shuffled, table.schema, max_files=1))
    rates.land_panes(stream, root, str(tmp_path / "state"), bounded=True).awaitTermination()
    with monkeypatch.context() as m:
        m.setattr(Files, "delete", lambda self, name: (_ for _ in ()).throw(OSError("stopped")) if name.startswith("batch=") else None)
        with pytest.raises(OSError):
            rates.compact_panes(spark, root)
    assert len([n for n in os.listdir(root) if n.startswith("batch=")]) == 8
    want = rows(ops.event_rate_5m(timed(table)))
    assert rows(rates.landed_rate_5m(spark, root)) == want
    rates.compact_panes(spark, root)
    assert rows(rates.landed_rate_5m(spark, root)) == want and len([n for n in os.listdir(root) if n.startswith("batch=")]) == 1


def test_load_time_freshness_from_files(spark, tmp_path, frame):
    """Five tables; pass, warn and error by the time of the newest file, which no reader opens."""
    now = 1_700_000_000
    for name, hours in {"events": 1, "customers": 3, "products": 4, "orders": 7, "inventory": None}.items():
        (tmp_path / name / "p=1").mkdir(parents=True)
        if hours is not None:
            for age, file in ((hours, "part-1.parquet"), (hours + 50, "part-0.parquet"), (0, "_SUCCESS")):
                (tmp_path / name / "p=1" / file).write_text("not Parquet")
                os.utime(tmp_path / name / "p=1" / file, (now - age * 3600, now - age * 3600))
    paths = {n: str(tmp_path / n) for n in ("events", "customers", "products", "orders", "inventory", "absent")}
    paths["absent"] = str(tmp_path / "nowhere")
    got = checkpoints.file_freshness(spark, paths, F.timestamp_seconds(F.lit(now)))
    assert rows(got, "table_name", "age_seconds", "state") == [
        ("absent", None, "error"), ("customers", 10800, "pass"), ("events", 3600, "pass"), ("inventory", None, "error"), ("orders", 25200, "error"), ("products", 14400, "warn"),
    ]
