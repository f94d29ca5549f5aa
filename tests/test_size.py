"""Steps that several queries share read their input once, and a task's share of it does not grow with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collected import rows
from tillhouse import session
from tillhouse.catalog import queries
from tillhouse.operators import constraints, privacy
from tillhouse.plans import medallion
from tillhouse.schemas import BRONZE_CSV

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_table_tests_build_every_view_once(spark, sf, monkeypatch):
    built, staged = [], queries.Retail.staged
    monkeypatch.setattr(queries.Retail, "staged", lambda self, name: built.append(name) or staged(self, name))
    queries.QUERIES["table_tests"](spark, sf)
    assert sorted(built) == sorted(queries.staging.STAGE)


def given_files(df: DataFrame, sf: str) -> list[str]:
    return [f for f in df.inputFiles() if sf in f]


def test_staging_is_loaded_from_stored_rows(spark, sf, monkeypatch):
    seen = []
    monkeypatch.setattr(queries.writers, "load_staging", lambda df, path: seen.append(given_files(df, sf)) or df.write.mode("overwrite").parquet(path + "/x=1"))
    monkeypatch.setattr(queries.staging, "STAGE", {"products": queries.staging.STAGE["products"]})
    try:
        queries.QUERIES["staging_loaded"](spark, sf)
    except Exception:  # the stub stamps no load time
        pass
    assert seen == [[], [], []]


def test_constraint_loads_read_stored_rows(spark, sf, monkeypatch):
    seen, enforce = [], constraints.enforce
    monkeypatch.setattr(constraints, "enforce", lambda df, name, before: seen.append(given_files(df, sf) + given_files(before, sf)) or enforce(df, name, before=before))
    queries.QUERIES["constraint_loads"](spark, sf)
    assert seen == [[]] * 5


def test_rows_loaded_before_and_keys_with_nulls(frame):
    schema = "a string, b string"
    df, before = frame(schema, ("1", "x"), ("1", "x"), ("2", "x"), (None, "x"), (None, "x"), ("3", "x")), frame(schema, ("2", "x"), ("2", "x"), (None, "x"), ("9", "x"))
    done = constraints.enforce(df.coalesce(1), "none", before=before, keys=(("a", "b"),))
    assert rows(done.loaded, "a", "b") == rows(frame(schema, ("1", "x"), (None, "x"), (None, "x"), ("3", "x")), "a", "b")
    assert rows(done.counts(), "rule", "rows") == [("unique:a,b", 2)]


def test_partitions_follow_the_files(spark, sf, monkeypatch):
    paths = [f"{sf}/lineitem.parquet", f"{sf}/no such table"]
    try:
        monkeypatch.setattr(session, "BYTES_PER_PARTITION", 1024)
        session.configure_tables(spark, paths)
        assert int(spark.conf.get(INITIAL)) == session.stored_bytes(spark, paths[0]) // 1024 > 4
        monkeypatch.setattr(session, "BYTES_PER_PARTITION", 1 << 40)
        session.configure_tables(spark, paths)
        assert spark.conf.get(INITIAL, None) is None
        queries.Retail(spark, sf)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "4m"
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    finally:
        spark.conf.unset(INITIAL)


def test_audit_rows_are_compiled(spark, sf):
    plan = queries.Retail(spark, sf).audit()._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_action_of_any_detector(frame):
    text = frame("t string", ("1 Main St",), ("c/o Dr. Lee, 1 Main St",), ("x",), (None,))
    own = lambda c: F.array(F.lit("B"), F.lit("A"), F.lit("B"))
    got = text.select(privacy.suppression_action(F.col("t")).alias("a"), privacy.suppression_action(F.col("t"), own).alias("b")).collect()
    assert [r["a"] for r in got] == ["suppress (entities: LOCATION)", "suppress (entities: LOCATION, PERSON)", "suppress", "suppress"]
    assert {r["b"] for r in got} == {"suppress (entities: A, B)"}


def test_silver_keeps_nothing_in_memory(spark, tmp_path, monkeypatch):
    monkeypatch.delattr(DataFrame, "persist")
    bronze = spark.createDataFrame([("C1", "n", "a@b.c", "+1", "1 Main St", "2024-01-01", "gold", "0", "0")], "customer_id string, customer_name string, customer_email string, customer_phone string, shipping_address string, registration_date string, tier string, total_orders string, total_spent string")
    assert set(bronze.columns) == set(BRONZE_CSV["customers"].names)
    done = medallion.write_silver(bronze, "customers", "2024-01-30", str(tmp_path / "t"), str(tmp_path / "a"), "r")
    assert (done["rows_in"], done["rows_out"], done["pii"]) == (1, 1, 4)
