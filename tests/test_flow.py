"""Storage, streams and the whole run."""

from __future__ import annotations

import json
import os
import pathlib
import re
import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from collected import rows
from tillhouse import run as cli
from tillhouse.catalog.queries import QUERIES
from tillhouse.operators import conform, ingest
from tillhouse.plans import checkpoints, medallion, ops, star
from tillhouse.schemas import BRONZE_CSV, EVENT
from tillhouse.sources import driver_tables as given
from tillhouse.sources import ledger, readers, versions, writers
from tillhouse.streaming import bronze as streams
from tillhouse.streaming import rates

DAY = "2024-01-15"


# --- storage --------------------------------------------------------------------------------------


def test_missing_path_is_empty_and_other_errors_are_raised(spark, tmp_path):
    assert readers.read_bronze_csv(spark, str(tmp_path), "orders").schema == BRONZE_CSV["orders"]
    assert readers.read_bronze_events(spark, str(tmp_path / "none"), DAY).count() == 0
    with pytest.raises(AnalysisException):
        readers.read_or_empty(spark, EVENT, lambda: spark.sql("SELECT nothing FROM nowhere"))


def test_csv_round_trip_and_bronze_day(spark, tmp_path, frame):
    products = frame(", ".join(f"{c} string" for c in BRONZE_CSV["products"].fieldNames()), tuple("p,\"x" if i == 1 else str(i) for i in range(9)))
    writers.write_bronze_csv(products, str(tmp_path), "products")
    assert rows(readers.read_bronze_csv(spark, str(tmp_path), "products")) == rows(products)
    for kind, day in (("order_placed", DAY), ("order_placed", "2024-01-16"), ("order_shipped", DAY)):
        folder = tmp_path / "events" / f"event_type={kind}" / f"date={day}"
        folder.mkdir(parents=True)
        (folder / "x.json").write_text(json.dumps({"event_id": kind + day, "event_timestamp": day, "quantity": 1}) + "\n")
    got = readers.read_bronze_events(spark, str(tmp_path / "events"), DAY)
    assert rows(got, "event_id", "event_type", "quantity") == [("order_placed" + DAY, "order_placed", 1), ("order_shipped" + DAY, "order_shipped", 1)]
    assert "PartitionFilters: [isnotnull(date" in re.sub(r"#\d+", "", got._jdf.queryExecution().executedPlan().toString())
    assert readers.read_bronze_events(spark, str(tmp_path / "events"), DAY, ["order_shipped"]).count() == 1


def test_partition_overwrite_replaces_only_what_is_written(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    writers.write_table(frame("v int, d string", (1, "a"), (2, "b")), path, ["d"])
    writers.write_table(frame("v int, d string", (9, "b")), path, ["d"], only_present=True)
    assert rows(spark.read.parquet(path), "v", "d") == [(1, "a"), (9, "b")]
    writers.write_run_partition(frame("v int, pipeline_run_id string", (1, "r1")), path + "2")
    writers.write_run_partition(frame("v int, pipeline_run_id string", (2, "r1"), (3, "r2")), path + "2")
    assert rows(spark.read.parquet(path + "2"), "v") == [(2,), (3,)]
    assert rows(readers.read_silver(spark, str(tmp_path), "t", d="b"), "v", "d") == [(9, "b")]


def test_staging_load_keeps_the_old_table_on_empty_input(spark, tmp_path, frame):
    path = str(tmp_path / "s")
    assert writers.load_staging(frame("v int", (1,)), path)
    assert not writers.load_staging(frame("v int", (1,)).where("v > 1"), path)
    assert spark.read.parquet(path).columns == ["v", "_silver_loaded_at"]


def test_versioned_upsert(spark, tmp_path, frame):
    root = str(tmp_path / "log")
    assert readers.table_exists(spark, root) is False and writers.read_version(spark, root) is None
    writers.upsert_table(frame("id string, a int, b int", ("x", 1, 1)), root, ["id"], ["a"])
    writers.upsert_table(frame("id string, a int, b int", ("x", 5, 5), ("y", 2, 2)), root, ["id"], ["a"])
    assert rows(writers.read_version(spark, root)) == [("x", 5, 1), ("y", 2, 2)]


def test_a_broken_write_leaves_the_old_version(spark, tmp_path, frame):
    root = tmp_path / "t"
    for n in range(5):
        writers.write_version(frame("v int", (n,)), str(root))
    kept = sorted(p.name for p in root.iterdir() if p.is_dir())
    assert len(kept) == writers.KEEP_VERSIONS and rows(writers.read_version(spark, str(root))) == [(4,)]
    breaks = frame("v int", (1,)).select(F.raise_error(F.lit("lost")).cast("int").alias("v"))
    with pytest.raises(Exception, match="lost"):
        writers.write_version(breaks, str(root))
    (root / "v99999999").mkdir()  # a write that had only made its folder
    assert rows(writers.read_version(spark, str(root))) == [(4,)]
    for name in kept:
        os.remove(root / name / "_SUCCESS")
    with pytest.raises(RuntimeError, match="none of them was finished"):
        writers.read_version(spark, str(root))


def test_ledger_and_retention(frame):
    drops = frame("drop_id string", ("a",), ("b",))
    assert rows(writers.ingest_once(drops, frame("drop_id string", ("a",)))) == [("b",)]
    days = frame("date string, v int", ("2024-01-08", 1), ("2024-01-07", 2), ("2024-01-07", 3), (None, 4)).select(F.col("date").cast("date"), "v")
    assert [tuple(map(str, r)) for r in rows(writers.expired_partitions(days, DAY))] == [("2024-01-07", "2")]
    assert rows(writers.drop_expired(days, DAY), "v") == [(1,), (4,)]


# --- streams --------------------------------------------------------------------------------------


def write_messages(folder, name, *texts):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n")


def message(i, minute=0, kind="order_placed", **more):
    return json.dumps({"event_id": i, "event_type": kind, "event_timestamp": f"{DAY}T10:{minute:02d}:00.000Z", "order_id": "o", "customer_id": "c"} | more)


def test_stream_to_bronze_resumes_without_loss_or_copies(spark, tmp_path):
    source, root, state = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "state")

    def take():
        streams.stream_bronze(streams.file_messages(spark, str(source), max_files=1), root, state, bounded=True).awaitTermination()

    write_messages(source, "1.txt", message("a"), "{broken", message("b", kind="odd"))
    write_messages(source, "2.txt", message("c", kind="order_shipped"))
    take()
    write_messages(source, "3.txt", message("d"))
    take()
    take()
    stored = readers.read_bronze_events(spark, f"{root}/events", DAY)
    assert rows(stored, "event_id", "event_type") == [("a", "order_placed"), ("c", "order_shipped"), ("d", "order_placed")]
    written = [len([n for n in names if n.endswith(".json")]) for _, _, names in os.walk(f"{root}/events")]
    assert max(written) == 1  # one file per type, day and batch
    assert rows(spark.read.json(f"{root}/quarantine"), "reject_reason") == [("malformed",), ("unknown:event_type",)]
    metrics = spark.read.parquet(f"{root}/metrics").groupBy("event_type").agg(F.sum("processed"), F.sum("failed"))
    assert rows(metrics) == [("order_placed", 2, 0), ("order_shipped", 1, 0), ("unknown", 0, 2)]


def parsed_stream(spark, folder):
    parsed = ingest.accepted(ingest.parse_events(streams.file_messages(spark, str(folder), max_files=1)))
    return parsed.withColumn("event_timestamp", F.try_to_timestamp("event_timestamp"))


def test_stream_dedup_across_batches(spark, tmp_path):
    write_messages(tmp_path / "in", "1.txt", message("a"), message("a"), message("b"))
    write_messages(tmp_path / "in", "2.txt", message("a", minute=5), message("b", kind="order_shipped"))
    unique = streams.stream_dedup_events(parsed_stream(spark, tmp_path / "in"))
    got = streams.run_bounded(unique.select("event_id", "event_type"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert rows(got) == [("a", "order_placed"), ("b", "order_placed"), ("b", "order_shipped")]


def test_stream_rates_equal_batch_on_closed_windows(spark, tmp_path, sf):
    events = given.envelopes(given.read(spark, sf, "events")).withColumn("event_timestamp", F.try_to_timestamp("event_timestamp"))
    path = f"{sf}/events.parquet"
    stream = given.envelopes(streams.table_stream(spark, path, spark.read.parquet(path).schema)).withColumn("event_timestamp", F.try_to_timestamp("event_timestamp"))
    last = events.agg(F.max("event_timestamp")).first()[0]
    for batch, live, name in ((ops.event_rate_5m, rates.stream_event_rate_5m, "m5"), (ops.event_rate_1h, rates.stream_event_rate_1h, "h1")):
        got = streams.run_bounded(live(stream), str(tmp_path / name), str(tmp_path / f"{name}-state"))
        closed = batch(events).where(F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 1 HOUR"))
        assert rows(got) == rows(closed) and got.count() > 100


def test_landed_rates_equal_batch_on_all_windows(spark, tmp_path, sf):
    given_events = given.read(spark, sf, "events")
    # eight files whose rows lie all over the time range, taken one by one
    given_events.repartition(8, "event_id").write.parquet(str(tmp_path / "in"))
    timed = lambda df: given.envelopes(df).withColumn("event_timestamp", F.try_to_timestamp("event_timestamp"))
    stream = timed(streams.table_stream(spark, str(tmp_path / "in"), given_events.schema, max_files=1))
    root = str(tmp_path / "panes")
    for _ in range(2):  # nothing is new the second time
        rates.land_panes(stream, root, str(tmp_path / "state"), bounded=True).awaitTermination()
    assert len(os.listdir(root)) == 8
    assert rows(rates.landed_rate_5m(spark, root)) == rows(ops.event_rate_5m(timed(given_events)))
    assert rows(rates.landed_rate_1h(spark, root)) == rows(ops.event_rate_1h(timed(given_events)))
    assert rates.landed_rate_1h(spark, str(tmp_path / "none")).count() == 0


def test_late_rows_are_counted(spark, tmp_path):
    next_day = json.dumps(json.loads(message("b")) | {"event_timestamp": "2024-01-16T10:00:00Z"})
    # a batch filters with the watermark its predecessor started from, so the row is late in the fourth
    for n, text in enumerate((message("a"), next_day, next_day, message("late", minute=1))):
        write_messages(tmp_path / "in", f"{n}.txt", text)
        os.utime(tmp_path / "in" / f"{n}.txt", (1_700_000_000 + n, 1_700_000_000 + n))
    query = (
        rates.stream_event_rate_5m(parsed_stream(spark, tmp_path / "in")).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rates.late_rows(query) == 1


# --- the whole run --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bronze_root(spark, sf, tmp_path_factory):
    """Bronze layer of one day: batch drops that keep every rule, and the stream's events of that day."""
    root = str(tmp_path_factory.mktemp("lake"))
    orders = given.orders(spark, sf).where("order_amount <= 50000").withColumn("order_amount", F.col("quantity") * F.col("unit_price"))
    customers = given.customers(spark, sf).where("tier <> 'unrated'")
    orders = orders.join(customers.select("customer_id"), "customer_id", "left_semi").select(*given.orders(spark, sf).columns)
    batch = {"orders": orders.where("order_amount <= 50000"), "customers": customers, "products": given.products(spark, sf), "inventory": given.inventory(spark, sf)}
    for name, df in batch.items():
        writers.write_bronze_csv(given.as_bronze(df), f"{root}/bronze", name)
    clean = given.events(spark, sf).where("order_amount IS NULL OR quantity > 0")
    source = f"{root}/messages"
    given.messages(clean).write.text(source)
    streams.stream_bronze(streams.file_messages(spark, source), f"{root}/bronze", f"{root}/state", bounded=True).awaitTermination()
    return root


def layers(spark, root):
    names = [*(f"gold/{t}" for t in medallion.GOLD), *(f"marts/{t}" for t in medallion.MARTS)]
    return {n: rows(spark.read.parquet(f"{root}/{n}")) for n in names}


def test_run_twice_changes_nothing(spark, bronze_root):
    now = F.lit(f"{DAY} 23:59:59")
    run = medallion.start_run(spark, bronze_root, "run-1", DAY)
    tests = medallion.run_all(run, "1995-01-01", "2024-12-31", now, "2024-01-15 12:00:00")
    assert tests.count() > 20 and tests.where("failures > 0").count() == 0
    first = layers(spark, bronze_root)
    assert all(first.values())
    masked = rows(spark.read.parquet(f"{bronze_root}/silver/customers"))
    assert not any("@" in str(r) or "+1202" in str(r) or "Main St" in str(r) for r in masked)
    pii = spark.read.parquet(f"{bronze_root}/audit/pii_log").count()

    medallion.run_all(medallion.start_run(spark, bronze_root, "run-1", DAY), "1995-01-01", "2024-12-31", now, "2024-01-15 13:00:00")
    assert layers(spark, bronze_root) == first
    assert spark.read.parquet(f"{bronze_root}/audit/pii_log").count() == pii
    history = writers.read_version(spark, f"{bronze_root}/gold/customer_history")
    assert history.count() == len(first["gold/dim_customers"]) and history.select("valid_from").distinct().count() == 1
    log = writers.read_version(spark, f"{bronze_root}/audit/run_log")
    assert rows(log, "stage", "status", "quality_passed") == [
        ("gold", "success", None), ("ingest", "success", None), ("quality", "success", True), ("retention", "success", None), ("silver", "success", None), ("staging", "success", None),
    ]
    days = {p.name for kind in os.listdir(f"{bronze_root}/bronze/events") if "=" in kind for p in pathlib.Path(f"{bronze_root}/bronze/events/{kind}").iterdir()}
    assert min(days) == "date=2024-01-08" and f"date={DAY}" in days
    gone = versions.read_version(spark, f"{bronze_root}/audit/retention")
    assert gone.count() > 0 and gone.where("day >= DATE '2024-01-08' OR removed_at IS NULL").count() == 0
    silver = log.where("stage = 'silver'").first()
    assert silver["pii_events_masked"] == pii and silver["records_processed"] > 4000
    assert ops.last_success(ops.run_view(log)).first()["run_id"] == "run-1"
    assert spark.read.parquet(f"{bronze_root}/audit/validation").count() == 5


def test_violating_drops_leave_gold_unchanged(spark, bronze_root, tmp_path):
    """Rows that break a check or repeat a key reach the quarantine with the rule's name, and no dimension, fact or mart."""
    root = str(tmp_path / "lake")
    for layer in ("silver", "staging", "gold", "marts"):
        shutil.copytree(f"{bronze_root}/{layer}", f"{root}/{layer}")
    before, run = layers(spark, root), medallion.start_run(spark, root, "run-5", DAY)
    good = {t: spark.read.parquet(medallion.silver_path(run, t)) for t in medallion.TABLES}
    first = {t: df.limit(3) for t, df in good.items()}
    bad = {
        "orders": first["orders"].withColumn("order_id", F.concat(F.lit("X"), "order_id")).withColumn("quantity", F.lit(0)).unionByName(first["orders"]),
        "customers": first["customers"].unionByName(first["customers"].withColumn("customer_id", F.lit(None).cast("string"))),
        "products": first["products"], "inventory": first["inventory"],
    }
    for table in medallion.TABLES:
        path = medallion.silver_path(run, table)
        if table != "events":  # one file after those that are there: the rows loaded first win
            bad[table].coalesce(1).write.parquet(str(tmp_path / table))
            shutil.copy(next((tmp_path / table).glob("*.parquet")), f"{path}/part-99999-late.parquet")
    medallion.run_staging(run)
    medallion.run_gold(run, "1995-01-01", "2024-12-31")
    assert layers(spark, root) == before
    aside = lambda t: spark.read.parquet(f"{root}/audit/quarantine/table_name={t}/pipeline_run_id=run-5")
    rules = {t: sorted(r["rule"] for r in aside(t).select(F.explode("broken_rules").alias("rule")).collect()) for t in medallion.TABLES}
    assert rules["orders"] == ["check:quantity_positive"] * 3 + ["unique:order_line_id"] * 3
    assert rules["customers"] == ["not_null:customer_id"] * 3 + ["unique:customer_id"] * 3
    assert rules["products"] == ["unique:product_id"] * 3 and rules["events"] == []
    assert rules["inventory"] == ["unique:snapshot_date,product_id,warehouse_region"] * 3
    log = writers.read_version(spark, f"{root}/audit/run_log").where("stage = 'staging'").first()
    assert (log["status"], log["records_failed"]) == ("success", 18)


def test_landing_drops_are_loaded_once(spark, sf, tmp_path):
    run = medallion.start_run(spark, str(tmp_path), "run-6", DAY)
    products = given.as_bronze(given.products(spark, sf))
    for n, part in enumerate(products.randomSplit([1.0, 1.0], 3)):
        part.write.option("header", True).csv(f"{tmp_path}/landing/products/drop-{n}")
    assert medallion.run_ingest(run)["products"] == ["drop-0", "drop-1"]
    assert medallion.run_ingest(run) == {t: [] for t in BRONZE_CSV}
    assert rows(medallion._bronze(run, "products")) == rows(products)
    assert ledger.ledger(spark, run.path("bronze")).count() == 2
    assert medallion._bronze(run, "orders").count() == 0  # no ledger: the plain drop, which is not there
    log = writers.read_version(spark, f"{tmp_path}/audit/run_log").first()
    assert (log["stage"], log["status"]) == ("ingest", "success")


def test_calendar_comes_from_the_data(spark, bronze_root):
    run = medallion.start_run(spark, bronze_root, "run-7", DAY)
    stg = medallion.views(run)
    days = stg["orders"].select(F.col("order_date").alias("d")).unionByName(stg["inventory"].select(F.col("inventory_date").alias("d")))
    days = days.unionByName(stg["events"].select(F.col("event_timestamp").cast("date").alias("d")))
    low, high = days.agg(F.min("d").cast("string"), F.max("d").cast("string")).first()
    assert star.calendar_bounds(stg) == (low, high) and high == DAY
    with pytest.raises(ValueError, match="no dated rows"):
        star.calendar_bounds({t: df.limit(0) for t, df in stg.items()})


def test_rows_outside_the_calendar_are_counted(spark, bronze_root):
    run = medallion.start_run(spark, bronze_root, "run-8", DAY)
    stg = medallion.views(run)
    dates = star.dim_date(spark, "1995-01-01", "1996-12-31")
    got = {r["table_name"]: (r["undated"], r["outside"]) for r in star.outside_calendar(stg, dates).collect()}
    inside = stg["orders"].where("order_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'").count()
    assert got["orders"] == (0, stg["orders"].count() - inside) and got["orders"][1] > 0
    assert got["events"] == (0, stg["events"].count()) and got["inventory"][1] > 0
    undated = stg | {"orders": stg["orders"].withColumn("order_date", F.lit(None).cast("date"))}
    assert star.outside_calendar(undated, dates).where("table_name = 'orders'").first()["undated"] == stg["orders"].count()


def test_silver_reads_each_bronze_table_once(spark, sf, tmp_path):
    """Rows that pass the reader, counted on the executors, against rows in the input; the counts of the stage come from the same pass."""
    for table, reads in (("customers", 1), ("products", 1), ("orders", 1), ("inventory", 1), ("events", 2)):
        bronze = getattr(given, table)(spark, sf)
        bronze = spark.createDataFrame((bronze if table == "events" else given.as_bronze(bronze)).collect(), bronze.schema if table == "events" else given.as_bronze(bronze).schema)
        if table == "products":
            bronze = bronze.withColumn("product_id", F.when(F.col("product_id") != "PROD-7", F.col("product_id"))).withColumn("unit_price", F.when(F.col("product_id") == "PROD-8", "x").otherwise(F.col("unit_price")))
        passed = spark.sparkContext.accumulator(0)

        def count(batches, passed=passed):
            for b in batches:
                passed.add(len(b))
                yield b

        n = bronze.count()
        counts = medallion.write_silver(bronze.mapInArrow(count, bronze.schema), table, DAY, f"{tmp_path}/{table}", f"{tmp_path}/audit/{table}", "r")
        assert passed.value == reads * n and counts["rows_in"] == n, table
        assert counts["rows_out"] == spark.read.parquet(f"{tmp_path}/{table}").count()
        if table == "products":
            assert (counts["rows_out"], counts["failed_unit_price"], counts["failed_cost_price"]) == (n - 1, 1, 0)


def test_command_line(spark, tmp_path, sf):
    given.as_bronze(given.products(spark, sf)).write.option("header", True).csv(f"{tmp_path}/landing/products/p1")
    assert cli.main(["--root", str(tmp_path), "--date", DAY, "--run-id", "c1", "--stage", "ingest"], spark) == 0
    assert ledger.ledger(spark, f"{tmp_path}/bronze").first()["run_id"] == "c1"
    # nothing else is there: the whole run stops at the gate, says so, and leaves its rows in the log
    assert cli.main(["--root", str(tmp_path), "--date", DAY, "--run-id", "c2"], spark) == 1
    log = writers.read_version(spark, f"{tmp_path}/audit/run_log").where("run_id = 'c2'")
    assert ("quality", "failed") in rows(log, "stage", "status")
    assert spark.read.parquet(f"{tmp_path}/audit/cast_failures").where("run_id = 'c2'").count() == 21
    with pytest.raises(SystemExit):
        cli.arguments(["--root", "x", "--date", "15.1.2024"])


def test_gate_stops_the_run(spark, bronze_root):
    run = medallion.start_run(spark, bronze_root, "run-2", "2024-01-03")
    medallion.run_silver(run)
    with pytest.raises(checkpoints.GateFailed, match="freshness"):
        medallion.run_quality(run, F.lit("2024-01-04 12:00:00"))
    log = writers.read_version(spark, f"{bronze_root}/audit/run_log").where("run_id = 'run-2' AND stage = 'quality'").first()
    assert (log["status"], log["quality_passed"]) == ("failed", False)


def test_absent_silver_fails_the_gate_and_is_logged(spark, tmp_path):
    run = medallion.start_run(spark, str(tmp_path), "run-9", DAY)
    with pytest.raises(checkpoints.GateFailed, match="events"):
        medallion.run_quality(run, F.lit(f"{DAY} 23:59:59"))
    stored = spark.read.parquet(f"{tmp_path}/audit/validation")
    assert stored.count() == 5 and stored.where("success").count() == 0
    assert rows(stored.where("suite_name <> 'silver_freshness'"), "evaluated_expectations") == [(0,)] * 4
    log = writers.read_version(spark, f"{tmp_path}/audit/run_log")
    assert rows(log, "stage", "status") == [("quality", "failed")]


def test_failing_table_tests_stop_before_the_snapshot(spark, bronze_root, monkeypatch):
    bad = spark.createDataFrame([("stg_orders", "not_null", "order_id", 3)], "table_name string, test_name string, column_name string, failures long")
    monkeypatch.setattr(medallion, "run_tests", lambda run: bad)
    monkeypatch.setattr(medallion, "run_snapshot", lambda run, at: pytest.fail("snapshot taken"))
    run = medallion.start_run(spark, bronze_root, "run-4", DAY)
    with pytest.raises(medallion.TableTestsFailed, match="stg_orders.not_null.order_id"):
        medallion.run_all(run, "1995-01-01", "2024-12-31", F.lit(f"{DAY} 23:59:59"), "2024-01-15 14:00:00")
    log = writers.read_version(spark, f"{bronze_root}/audit/run_log").where("run_id = 'run-4'")
    assert ("gold", "failed") in rows(log, "stage", "status")


def test_a_failing_table_does_not_stop_the_others(spark, bronze_root, monkeypatch):
    real = medallion._bronze
    monkeypatch.setattr(medallion, "_bronze", lambda run, t: real(run, t).select("no_such_column") if t == "products" else real(run, t))
    run = medallion.start_run(spark, bronze_root, "run-3", DAY)
    with pytest.raises(medallion.StageFailed, match="products"):
        medallion.run_silver(run)
    log = writers.read_version(spark, f"{bronze_root}/audit/run_log").where("run_id = 'run-3'").first()
    assert (log["status"], log["tables_failed"]) == ("failed", 1) and log["records_processed"] > 0


# --- plans ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["fact_orders", "dim_customers", "mart_sales_summary", "mart_return_rates", "mart_customer_cohorts", "silver_events"])
def test_no_query_moves_its_rows_into_one_partition(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    single = plan.count("SinglePartition")
    # the offsets of a dense key: one row per chunk
    assert single <= (1 if name in ("fact_orders", "dim_customers") else 0)
    assert "CartesianProduct" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_scans_read_only_what_is_needed(spark, sf):
    plan = QUERIES["mart_customer_cohorts"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "p_name" not in plan and "l_extendedprice" in plan and "c_name" not in plan


def test_event_drop_counts_add_up(spark, sf):
    counts = conform.event_drop_counts(given.events(spark, sf)).first()
    assert counts["rows_in"] == counts["missing_event_id"] + counts["repeated_copies"] + counts["missing_key"] + counts["rows_out"]
