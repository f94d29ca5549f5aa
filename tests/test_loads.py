"""What happens when rows are loaded: the ledger, constraints, retention."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from collected import rows
from tillhouse.operators import constraints
from tillhouse.sources import ledger, retention, versions
from tillhouse.sources.files import Files

DAY = "2024-01-15"


# --- ledger ---------------------------------------------------------------------------------------


def total(spark, root, df):
    return rows(ledger.loaded(spark, root, "orders", df.schema))


def stop(*_):
    raise OSError("stopped")


@pytest.mark.parametrize("step", ["before the marker", "before the row", "after the row"])
def test_a_stop_at_any_step_still_loads_once(spark, tmp_path, frame, monkeypatch, step):
    root, df = str(tmp_path / "bronze"), frame("v int", (1,), (2,))
    with monkeypatch.context() as m:
        if step == "before the marker":  # the write had not finished
            m.setattr(ledger, "_enter", lambda files, entity, drop, folder, run: (files.delete(f"{folder}/_SUCCESS"), stop()))
        elif step == "before the row":
            m.setattr(Files, "create_new", stop)
        else:
            real = Files.create_new
            m.setattr(Files, "create_new", lambda *a: (real(*a), stop()))
        with pytest.raises(OSError, match="stopped"):
            ledger.load_drop(df, root, "orders", "d1")
    assert total(spark, root, df) == ([(1,), (2,)] if step == "after the row" else [])
    assert ledger.load_drop(df, root, "orders", "d1") is (step != "after the row")
    assert ledger.load_drop(df, root, "orders", "d1") is False
    assert total(spark, root, df) == [(1,), (2,)]
    assert rows(ledger.ledger(spark, root), "drop_id", "entity") == [("d1", "orders")]
    # the folder of the stopped load goes with the sweep, not before it is old
    assert ledger.sweep(spark, root) == []
    assert len(ledger.sweep(spark, root, older_than_hours=0)) == (0 if step == "after the row" else 1)
    assert total(spark, root, df) == [(1,), (2,)]


def test_a_folder_without_its_marker_gets_no_row(spark, tmp_path):
    os.makedirs(tmp_path / "data" / "orders" / "d1.x")
    with pytest.raises(RuntimeError, match="no marker"):
        ledger._enter(Files(spark, str(tmp_path)), "orders", "d1", "data/orders/d1.x", "")
    assert ledger.ledger(spark, str(tmp_path)).count() == 0


def test_two_loaders_of_one_drop(spark, tmp_path, frame, monkeypatch):
    root, df, real = str(tmp_path), frame("v int", (1,)), ledger._enter

    def second(files, entity, drop, folder, run):
        monkeypatch.setattr(ledger, "_enter", real)
        assert ledger.load_drop(df, root, "orders", "d1", "faster")
        return real(files, entity, drop, folder, run)

    monkeypatch.setattr(ledger, "_enter", second)
    assert ledger.load_drop(df, root, "orders", "d1", "slower") is False
    assert total(spark, root, df) == [(1,)] and ledger.ledger(spark, root).first()["run_id"] == "faster"
    assert ledger.sweep(spark, root, older_than_hours=0) == []  # the slower one has cleaned up


def test_only_new_drops_are_loaded(spark, tmp_path, frame):
    root, df = str(tmp_path), frame("v int", (1,))
    assert ledger.load_drops(root, "orders", {"a": df, "b": df}) == ["a", "b"]
    assert ledger.load_drops(root, "orders", {"a": df, "b": df, "c": df.withColumn("v", F.lit(9))}) == ["c"]
    assert ledger.load_drops(root, "stock", {"a": df}) == ["a"]
    assert total(spark, root, df) == [(1,), (1,), (9,)]
    assert ledger.ledger(spark, root).where("bytes > 0 AND files > 0 AND loaded_at IS NOT NULL").count() == 4
    with pytest.raises(ValueError):
        ledger.load_drop(df, root, "orders", "../elsewhere")


# --- retention ------------------------------------------------------------------------------------


def test_retention_removes_folders_and_logs_them(spark, tmp_path):
    root, log = tmp_path / "events", str(tmp_path / "log")
    for kind in ("a", "b"):
        for day in ("2024-01-07", "2024-01-08", "2024-01-15", "unknown"):
            folder = root / f"event_type={kind}" / f"date={day}" / "batch=0"
            folder.mkdir(parents=True)
            (folder / "x.json").write_text("not read at all")
    (root / "date=2020-01-01.txt").write_text("a file, no folder")
    found = retention.remove_expired(spark, str(root), DAY, log, "r1")
    assert [x.folder for x in found] == ["event_type=a/date=2024-01-07", "event_type=b/date=2024-01-07"]
    assert sorted(p.name for p in (root / "event_type=a").iterdir()) == ["date=2024-01-08", "date=2024-01-15", "date=unknown"]
    logged = versions.read_version(spark, log)
    assert rows(logged, "run_id", "folder", "files", "bytes") == [("r1", f"event_type={k}/date=2024-01-07", 1, 15) for k in "ab"]
    assert logged.where("removed_at IS NULL").count() == 0
    assert retention.remove_expired(spark, str(root), DAY, log, "r1") == []
    assert versions.read_version(spark, log).count() == 2
    assert retention.remove_expired(spark, str(tmp_path / "none"), DAY, log, "r1") == []


def test_retention_that_stopped_half_way(spark, tmp_path, monkeypatch):
    root, log = tmp_path / "events", str(tmp_path / "log")
    for day in ("2024-01-01", "2024-01-02"):
        (root / f"date={day}").mkdir(parents=True)
    real, gone = Files.delete, []

    def once(self, name):
        if name.startswith("date=") and gone:
            stop()
        gone.append(name)
        return real(self, name)

    with monkeypatch.context() as m:
        m.setattr(Files, "delete", once)
        with pytest.raises(OSError):
            retention.remove_expired(spark, str(root), DAY, log, "r1")
    assert versions.read_version(spark, log).where("removed_at IS NULL").count() == 2
    retention.remove_expired(spark, str(root), DAY, log, "r2")
    assert list(root.iterdir()) == []
    assert rows(versions.read_version(spark, log), "run_id", "folder") == [("r1", "date=2024-01-01"), ("r1", "date=2024-01-02"), ("r2", "date=2024-01-02")]


# --- constraints ----------------------------------------------------------------------------------

ORDERS = "order_line_id string, order_id string, customer_id string, product_id string, quantity int, order_amount decimal(12,2), order_date timestamp, order_status string, note string"


def order(line, quantity=1, amount="5.00", customer="c", status="placed", note=""):
    from datetime import datetime
    from decimal import Decimal

    return (line, line, customer, "p", quantity, None if amount is None else Decimal(amount), datetime(2024, 1, 1), status, note)


def names(df):
    return sorted((r["note"], tuple(r["broken_rules"])) for r in df.collect())


def test_every_row_rule_quarantines_with_its_name(frame):
    df = frame(
        ORDERS, order("a", note="good"), order("b", 0, note="q"), order("c", amount="0.00", note="low"), order("d", amount="50000.01", note="high"),
        order("e", customer=None, note="c"), order(None, note="id"), order("f", 0, None, None, None, note="many"), order("g", amount="50000.00", note="edge"),
    )
    done = constraints.enforce(df, "orders")
    assert rows(done.loaded, "note") == [("edge",), ("good",)]
    assert names(done.quarantined) == [
        ("c", ("not_null:customer_id",)),
        ("high", ("check:order_amount_in_range",)),
        ("id", ("not_null:order_line_id", "not_null:order_id")),
        ("low", ("check:order_amount_in_range",)),
        ("many", ("not_null:customer_id", "not_null:order_amount", "not_null:order_status", "check:quantity_positive")),
        ("q", ("check:quantity_positive",)),
    ]
    assert rows(done.counts().where("rows > 1")) == [("check:order_amount_in_range", 2), ("check:quantity_positive", 2), ("not_null:customer_id", 2)]


def test_the_first_row_of_a_key_wins(frame):
    df = frame(ORDERS, order("a", 0, note="broken first"), order("a", note="first"), order("a", note="second"), order("b", note="b"), order("a", note="third")).coalesce(1)
    done = constraints.enforce(df, "orders")
    assert rows(done.loaded, "note") == [("b",), ("first",)]
    assert names(done.quarantined) == [("broken first", ("check:quantity_positive",)), ("second", ("unique:order_line_id",)), ("third", ("unique:order_line_id",))]


def test_rows_loaded_before_keep_their_keys(frame):
    before = frame(ORDERS, order("a", note="old"))
    done = constraints.enforce(frame(ORDERS, order("a", note="again"), order("a", note="twice"), order("b", note="new")), "orders", before)
    assert rows(done.loaded, "note") == [("new",)] and [n for n, _ in names(done.quarantined)] == ["again", "twice"]


def test_several_keys_and_null_parts(frame):
    df = frame("product_id string, sku string, note string", ("p1", "s1", "1"), ("p1", "s2", "2"), ("p2", "s1", "3"), ("p3", "s2", "4"), (None, "s9", "5")).coalesce(1)
    done = constraints.enforce(df, "products")
    assert rows(done.loaded, "note") == [("1",), ("4",)]  # row 2 lost its first key, so its second one is free
    assert names(done.quarantined) == [("2", ("unique:product_id",)), ("3", ("unique:sku",)), ("5", ("not_null:product_id",))]
    keyed = constraints.enforce(df, "no such table", keys=(("product_id", "sku"),))
    assert keyed.loaded.count() == 5  # a key with a null part is not compared
    assert constraints.enforce(df, "no such table").quarantined.count() == 0


def test_a_hot_key_is_not_gathered(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("customer_id"), F.col("id").alias("note")
    ).repartition(8, "note")
    done = constraints.enforce(df, "customers")
    assert done.loaded.count() == 4000 - 1333 and done.quarantined.count() == 1333
    plan = done.loaded._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
