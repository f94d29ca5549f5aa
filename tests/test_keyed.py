"""Keys from the place of a row, and pages that continue behind a key."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from collected import rows
from tillhouse.plans import serving
from tillhouse.sources import keyed


@pytest.fixture
def many_files(spark):
    """Small tables in as many files as large ones would have."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def size_below(root):
    return sum(os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(root) for n in names if not n.startswith("."))


def test_keys_are_ranks_and_the_table_is_written_once(spark, tmp_path, many_files):
    df = spark.range(20_000).select(((F.col("id") * 7919) % 20_000).alias("k"), F.md5(F.col("id").cast("string")).alias("v")).repartition(7)
    path = str(tmp_path / "t")
    got = keyed.write_keyed(df, path, ["k"], "key")
    assert got.columns == ["key", "k", "v"] and got.where("key <> k + 1").count() == 0 and got.count() == 20_000
    assert len([n for n in os.listdir(path) if n.endswith(".parquet")]) > 1
    df.write.parquet(str(tmp_path / "plain"))
    assert size_below(path) < 1.2 * size_below(tmp_path / "plain")
    assert size_below(tmp_path) < 1.2 * 2 * size_below(tmp_path / "plain")  # and no copy elsewhere
    again = keyed.read_keyed(spark, path)
    assert rows(again.where("k < 5"), "key", "k") == [(i + 1, i) for i in range(5)]
    assert "k" not in spark.read.parquet(path).drop("k").columns


def test_a_hot_value_lies_in_several_files(spark, tmp_path, many_files):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    got = keyed.write_keyed(df, str(tmp_path / "t"), ["k"], "key")
    files = got.select("k", "v").join(spark.read.parquet(str(tmp_path / "t")).select("v", F.col("_metadata.file_name").alias("f")), "v").where("k = 5")
    assert files.select("f").distinct().count() > 1
    assert got.agg(F.count_distinct("key"), F.min("key"), F.max("key")).first() == (9000, 1, 9000)
    assert got.orderBy("key").select("k").toPandas()["k"].is_monotonic_increasing


def test_writing_again_and_a_stop_before_the_side_file(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    keyed.write_keyed(frame("k int, x string", (2, "b"), (1, "a")), path, ["k"], "key", leave_out=["k"])
    assert rows(keyed.read_keyed(spark, path)) == [(1, "a"), (2, "b")]
    keyed.write_keyed(frame("k int, x string", (2, "b"), (1, "a"), (0, "z")), path, ["k"], "key", leave_out=["k"])
    assert rows(keyed.read_keyed(spark, path)) == [(1, "z"), (2, "a"), (3, "b")]
    os.remove(f"{path}/{keyed.OFFSETS}")
    with pytest.raises(RuntimeError, match="_keys.json"):
        keyed.read_keyed(spark, path)
    assert rows(keyed.read_keyed(spark, path, "key")) == [(1, "z"), (2, "a"), (3, "b")]
    empty = keyed.write_keyed(frame("k int", (1,)).where("k > 1"), path, ["k"], "key")
    assert empty.count() == 0 and empty.columns == ["key", "k"]


def rows_read(df):
    """Rows that the scan of a finished query gave out."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def visit(node):
        if node.getClass().getSimpleName() in ("AdaptiveSparkPlanExec",):
            return visit(node.executedPlan())
        if "FileSourceScan" in node.getClass().getSimpleName():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))
        if node.getClass().getSimpleName() in ("ShuffleQueryStageExec", "BroadcastQueryStageExec"):
            visit(node.plan())

    visit(plan)
    return sum(found)


def test_a_late_page_reads_no_more_than_the_first(spark, tmp_path, many_files):
    df = spark.range(200_000).select(F.format_string("P%08d", "id").alias("key"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("text"))
    table = serving.store_sorted(df.repartition(5), str(tmp_path / "t"), "key")
    seen, after, costs = [], None, []
    for page in range(4):
        got = serving.page_after(table, "key", after, size=500)
        seen += [r["key"] for r in got.collect()]
        after = seen[-1]
    assert seen == [f"P{i:08d}" for i in range(2000)]
    for start in (0, 60_000, 199_000):
        bound = None if start == 0 else f"P{start - 1:08d}"
        page = serving.page_after(table.where(F.col("key") < f"P{start + 5000:08d}"), "key", bound, size=500)
        costs.append(rows_read(page))
        assert page.first()["key"] == f"P{start:08d}"
    # the scan skips the row groups before the page: a late one costs no more than row groups at its edges
    assert max(costs[1:]) <= costs[0] + 20_000 and costs[0] < 50_000
    last = serving.page_after(table, "key", "P00199990", size=500)
    assert last.count() == 9 and serving.page_after(table, "key", "P00199999").count() == 0
