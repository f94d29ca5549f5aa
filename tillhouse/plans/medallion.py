"""One run over all layers: Bronze, Silver, gate, staging, star schema, tests, history, run log.

Folders below the root: ``landing/<table>/<drop>`` (CSV drops that wait), ``bronze`` (stream events below ``bronze/events``, drops
that the ledger lists below ``bronze/data``, or plain drops below ``bronze/batch``), ``silver``, ``staging``, ``gold``,
``marts``, ``audit``. Running a day again replaces what it wrote.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillhouse.operators import conform, constraints, privacy, rules
from tillhouse.plans import checkpoints, marts, staging, star, table_tests
from tillhouse.schemas import BRONZE_CSV, RUN_LOG
from tillhouse.session import configure_tables, materialize
from tillhouse.sources import history_table, ledger, retention
from tillhouse.sources.files import Files
from tillhouse.sources.keyed import read_keyed
from tillhouse.sources.readers import read_bronze_csv, read_bronze_events, read_csv_folder, read_or_empty, read_silver
from tillhouse.sources.writers import load_staging, upsert_table, write_table, write_validation

log = logging.getLogger(__name__)

DAILY = ("events", "orders", "inventory")  # Silver tables kept per run date
MASKED = ("events", "customers", "orders")
TABLES = ("events", "customers", "products", "orders", "inventory")
HISTORY_CHECKS = ("tier", "total_spent", "total_orders")


class StageFailed(RuntimeError):
    """A stage could not finish; the run log holds the reason's stage and status."""


@dataclass(frozen=True)
class Run:
    spark: SparkSession
    root: str
    run_id: str
    run_date: str

    def path(self, layer: str, table: str = "") -> str:
        return f"{self.root}/{layer}/{table}".rstrip("/")

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, table))


def default_run_date() -> str:
    return (date.today() - timedelta(days=1)).isoformat()


def start_run(spark: SparkSession, root: str, run_id: str, run_date: str | None = None) -> Run:
    return Run(configure_tables(spark), root.rstrip("/"), run_id, run_date or default_run_date())


# --- run log --------------------------------------------------------------------------------------


def log_stage(run: Run, stage: str, started: datetime, status: str, **values: object) -> None:
    """Upsert the stage's row; only the given columns, the end time and the status change on a rerun."""
    row = {
        "run_id": run.run_id, "stage": stage, "triggered_by": "scheduler", "start_time": started,
        "end_time": datetime.now(timezone.utc), "records_processed": 0, "records_failed": 0, "tables_failed": 0,
        "quality_passed": None, "pii_events_masked": 0, "status": status,
    } | values
    update = run.spark.createDataFrame([tuple(row[f.name] for f in RUN_LOG.fields)], RUN_LOG)
    upsert_table(update, run.path("audit", "run_log"), ["run_id", "stage"], ("end_time", "status", *values))


# --- ingest and retention -------------------------------------------------------------------------


def run_ingest(run: Run) -> dict[str, list[str]]:
    """Load every drop of the landing folder that the ledger does not list yet; returns the drops loaded per table."""
    started, landing, done = datetime.now(timezone.utc), Files(run.spark, run.path("landing")), {}
    try:
        for table in BRONZE_CSV:
            waiting = {e.name: read_csv_folder(run.spark, f"{landing.root}/{e.path}", table) for e in landing.list(table) if e.is_folder}
            done[table] = ledger.load_drops(run.path("bronze"), table, waiting, run.run_id)
    except Exception:
        log_stage(run, "ingest", started, "failed")
        raise
    log_stage(run, "ingest", started, "success", records_processed=sum(map(len, done.values())))
    return done


def run_retention(run: Run, keep_days: int = retention.KEEP_DAYS) -> list[retention.Expired]:
    """Remove the Bronze days that have left the retention period; ``audit/retention`` says which went."""
    started = datetime.now(timezone.utc)
    try:
        gone = list(retention.remove_expired(run.spark, run.path("bronze", "events"), run.run_date, run.path("audit", "retention"), run.run_id, keep_days))
    except Exception:
        log_stage(run, "retention", started, "failed")
        raise
    log_stage(run, "retention", started, "success", records_processed=len(gone))
    return gone


# --- Silver ---------------------------------------------------------------------------------------


def _bronze(run: Run, table: str) -> DataFrame:
    if table == "events":
        return read_bronze_events(run.spark, run.path("bronze", "events"), run.run_date)
    if Files(run.spark, run.path("bronze")).exists(f"ledger/{table}"):
        return ledger.loaded(run.spark, run.path("bronze"), table, BRONZE_CSV[table])
    return read_bronze_csv(run.spark, run.path("bronze"), table)


def silver_path(run: Run, table: str) -> str:
    suffix = f"/run_date={run.run_date}" if table in DAILY else ""
    return run.path("silver", table) + suffix


def _write_silver(run: Run, table: str) -> dict[str, int]:
    audit = run.path("audit", "pii_log") + f"/pipeline_run_id={run.run_id}/table_name={table}"
    return write_silver(_bronze(run, table), table, run.run_date, silver_path(run, table), audit, run.run_id)


def write_silver(bronze: DataFrame, table: str, run_date: str, path: str, audit_path: str, run_id: str) -> dict[str, int]:
    """Conform, mask and write one table together with its audit rows; returns the counts of the stage.

    Bronze is read once: the counts are observed by the job that stores the rows. That job has no shuffle for the batch
    tables, so Spark takes each of its partitions into account once, also when a task runs again. Events are deduplicated
    behind a shuffle, whose input may be counted twice when an executor is lost; they are counted by an aggregate of their own.
    """
    spark, counts = bronze.sparkSession, {}
    if table == "events":
        counts = bronze.agg(*conform.intake_counts(bronze, table)).first().asDict()
        clear = conform.silver_events(bronze, run_date).withColumn("silver_processed_at", F.current_timestamp())
        partitions, seen = ["event_type"], None
    else:
        seen = Observation()
        clear, partitions = conform.silver_table(bronze.observe(seen, *conform.intake_counts(bronze, table)), table), []
    pii = 0
    if table in MASKED:
        # masked values and audit cells only, so nothing in the clear is kept; stored, as a large table does not fit into memory
        masked = materialize(privacy.mask_with_audit(clear), f"masked-{table}")
        write_table(masked.drop("_pii"), path, partitions)
        audit = privacy.audit_rows_of(masked, run_id).withColumn("table_name", F.lit(table))
        write_table(audit.drop("pipeline_run_id", "table_name"), audit_path)
        pii = spark.read.parquet(audit_path).count()  # from the footers
    else:
        write_table(clear, path)
    counts = counts if seen is None else seen.get
    stored = read_or_empty(spark, StructType(), lambda: spark.read.parquet(path)).count() if seen is None else counts["keyed"]
    failed = {f"failed_{c}": counts[f"failed_{c}"] for c in conform.failed_columns(bronze.columns, table)}
    return {"rows_in": counts["rows_in"], "rows_out": stored, "pii": pii} | failed


def run_silver(run: Run) -> dict[str, dict[str, int] | str]:
    """Every table on its own: one that fails does not keep the others from being written.

    Returns the counts per table, or the error text of a failed one. The stage fails if any table did.
    """
    started, outcome = datetime.now(timezone.utc), {}
    for table in TABLES:
        try:
            outcome[table] = _write_silver(run, table)
        except Exception as problem:  # isolation is the point; the failure is recorded and raised below
            log.exception("Silver table %s failed", table)
            outcome[table] = str(problem)
    write_table(cast_failures(run.spark, outcome), run.path("audit", "cast_failures") + f"/run_id={run.run_id}")
    done = [c for c in outcome.values() if isinstance(c, dict)]
    failed = [t for t, c in outcome.items() if not isinstance(c, dict)]
    log_stage(
        run, "silver", started, "failed" if failed else "success",
        records_processed=sum(c["rows_out"] for c in done),
        records_failed=sum(c["rows_in"] - c["rows_out"] for c in done),
        pii_events_masked=sum(c["pii"] for c in done),
        tables_failed=len(failed),
    )
    if failed:
        raise StageFailed("Silver tables failed: " + ", ".join(failed))
    return outcome


def cast_failures(spark: SparkSession, outcome: dict) -> DataFrame:
    """(table_name, column_name, failures): Bronze values that no Silver column could take, as counted by the stage."""
    rows = [(t, k.removeprefix("failed_"), n) for t, c in outcome.items() if isinstance(c, dict) for k, n in c.items() if k.startswith("failed_")]
    return spark.createDataFrame(rows, "table_name string, column_name string, failures bigint")


def run_summary(spark: SparkSession, outcome: dict) -> DataFrame:
    """(table_name, rows_in, rows_out, rows_dropped, pii_masked) of a Silver stage."""
    rows = [(t, c["rows_in"], c["rows_out"], c["rows_in"] - c["rows_out"], c["pii"]) for t, c in outcome.items() if isinstance(c, dict)]
    return spark.createDataFrame(rows, "table_name string, rows_in bigint, rows_out bigint, rows_dropped bigint, pii_masked bigint")


# --- gate -----------------------------------------------------------------------------------------


def silver_table(run: Run, table: str) -> DataFrame:
    """The run's Silver rows of a table, partition columns restored."""
    if table in DAILY:
        return read_silver(run.spark, run.path("silver"), table, run_date=run.run_date)
    return read_silver(run.spark, run.path("silver"), table)


def run_quality(run: Run, now: Column | None = None) -> DataFrame:
    """Evaluate the checkpoints, store their results, and raise ``GateFailed`` if one failed.

    A Silver table that is not there counts as empty: its checkpoint evaluates nothing and fails.
    """
    started = datetime.now(timezone.utc)
    try:
        silver = {t: read_or_empty(run.spark, StructType(), lambda t=t: silver_table(run, t)) for t in checkpoints.GATED_TABLES}
        results = checkpoints.run_checkpoints(silver)
        fresh = checkpoints.freshness_check(silver["events"], checkpoints.pinned_now(run.run_date) if now is None else now)
        write_validation(checkpoints.validation_rows(results, run.run_id, fresh), run.path("audit", "validation"))
        stored = run.read("audit", "validation").where(F.col("pipeline_run_id") == run.run_id)
        checkpoints.quality_gate(stored)
    except Exception:
        log_stage(run, "quality", started, "failed", quality_passed=False)
        raise
    log_stage(run, "quality", started, "success", quality_passed=True)
    return stored


# --- staging and gold -----------------------------------------------------------------------------


def run_staging(run: Run) -> dict[str, bool]:
    """Load the five staging tables, each on its own; an empty source keeps the old table.

    Constraints hold on load: rows that break one go to ``audit/quarantine`` with the names of the rules they break.
    """
    started, loaded, failed, kept_out = datetime.now(timezone.utc), {}, [], 0
    for table, stage in staging.STAGE.items():
        try:
            split = constraints.enforce(stage(silver_table(run, table)), table)
            aside = run.path("audit", "quarantine") + f"/table_name={table}/pipeline_run_id={run.run_id}"
            write_table(split.quarantined, aside)
            kept_out += run.spark.read.parquet(aside).count()
            loaded[table] = load_staging(split.loaded, run.path("staging", table))
        except Exception:
            log.exception("staging table %s failed", table)
            failed.append(table)
    log_stage(run, "staging", started, "failed" if failed else "success", records_failed=kept_out, tables_failed=len(failed))
    if failed:
        raise StageFailed("staging tables failed: " + ", ".join(failed))
    return loaded


def views(run: Run) -> dict[str, DataFrame]:
    return {name: view(run.read("staging", name)) for name, view in staging.VIEW.items()}


def run_gold(run: Run, first_day: str | None = None, last_day: str | None = None) -> int:
    """Dimensions, facts and marts in dependency order, each stored before the next one reads it.

    The calendar covers the days of the staged orders, snapshots and events where no bound is given. Returns the number of rows
    that it does not cover, which marts leave out; ``audit/outside_calendar`` has them by table.
    """
    stg = views(run)
    if first_day is None or last_day is None:
        low, high = star.calendar_bounds(stg)
        first_day, last_day = first_day or low, last_day or high

    def store(layer: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        write_table(build(), run.path(layer, name))
        return run.read(layer, name)

    dates = store("gold", "dim_date", lambda: star.dim_date(run.spark, first_day, last_day))
    aside = run.path("audit", "outside_calendar") + f"/run_id={run.run_id}"
    write_table(star.outside_calendar(stg, dates), aside)
    store("gold", "dim_geography", lambda: star.dim_geography(run.spark))
    # these are written once, in the order of their keys
    customers = star.dim_customers(stg["customers"], stg["orders"], run.path("gold", "dim_customers"))
    products = star.dim_products(stg["products"], run.path("gold", "dim_products"))
    star.fact_orders(stg["orders"], customers, products, dates, run.path("gold", "fact_orders"))
    star.fact_events(stg["events"], customers, products, dates, run.path("gold", "fact_events"))
    velocity = store("gold", "inventory_velocity", lambda: star.inventory_velocity(stg["orders"], dates))
    star.fact_inventory_snapshots(stg["inventory"], velocity, products, dates, run.path("gold", "fact_inventory_snapshots"))
    store("marts", "mart_sales_summary", lambda: marts.mart_sales_summary(stg["orders"], customers, products, dates))
    store("marts", "mart_return_rates", lambda: marts.mart_return_rates(stg["orders"], products, dates))
    store("marts", "mart_customer_cohorts", lambda: marts.mart_customer_cohorts(stg["orders"], customers, dates))
    store("marts", "mart_inventory_alerts", lambda: marts.mart_inventory_alerts(stg["inventory"], velocity, products, dates))
    return run.spark.read.parquet(aside).agg(F.sum(F.col("undated") + F.col("outside"))).first()[0]


KEYED = {
    "dim_customers": "customer_key", "dim_products": "product_key", "fact_orders": "order_key", "fact_events": "event_key",
    "fact_inventory_snapshots": "snapshot_key",
}
GOLD = ("dim_customers", "dim_products", "dim_date", "fact_orders", "fact_events", "fact_inventory_snapshots")
MARTS = ("mart_sales_summary", "mart_return_rates", "mart_customer_cohorts", "mart_inventory_alerts")


def gold_table(run: Run, table: str) -> DataFrame:
    """A dimension or fact with its surrogate key."""
    return read_keyed(run.spark, run.path("gold", table), KEYED[table]) if table in KEYED else run.read("gold", table)


def run_source_freshness(run: Run, now: Column) -> DataFrame:
    """How old the staging tables are, by the times their files were written; ``audit/source_freshness`` keeps the run's rows."""
    found = checkpoints.file_freshness(run.spark, {t: run.path("staging", t) for t in TABLES}, now)
    path = run.path("audit", "source_freshness") + f"/run_id={run.run_id}"
    write_table(found, path)
    return run.spark.read.parquet(path)


def run_tests(run: Run) -> DataFrame:
    """Results of every declared table test and singular test over the stored tables."""
    stg = views(run)
    tables = {f"stg_{name}": df for name, df in stg.items()}
    tables |= {name: gold_table(run, name) for name in GOLD} | {name: run.read("marts", name) for name in MARTS}
    results = rules.run_table_tests(tables, **table_tests.for_tables(tables))
    singular = {
        "gmv_positive": ("fact_orders", rules.assert_gmv_positive(tables["fact_orders"])),
        "reorder_matches_product": ("stg_inventory", rules.assert_reorder_matches(stg["inventory"], stg["products"])),
        "no_future_orders": ("stg_orders", rules.assert_no_future_orders(stg["orders"])),
        "amount_equals_quantity_times_price": ("stg_orders", rules.assert_amount_matches(stg["orders"])),
    }
    for test, (table, failing) in singular.items():
        results = results.unionByName(
            failing.agg(F.count("*").alias("failures")).select(
                F.lit(table).alias("table_name"), F.lit(test).alias("test_name"), F.lit("").alias("column_name"), "failures"
            )
        )
    return results


class TableTestsFailed(RuntimeError):
    """A declared table test failed, so no snapshot may be taken."""


def require_tests(results: DataFrame) -> None:
    """Raise ``TableTestsFailed`` when a test counts failures. Reads one row per failing test."""
    failing = results.where("failures > 0").select("table_name", "test_name", "column_name").collect()
    if failing:
        raise TableTestsFailed("failed table tests: " + ", ".join(sorted(".".join(filter(None, r)) for r in failing)))


def run_snapshot(run: Run, at: str) -> list[int]:
    """Bring the customer history up to date with the customer dimension; only buckets with a change are written."""
    current = run.read("gold", "dim_customers")  # as stored: the key is not part of the history
    return history_table.snapshot(current, run.path("gold", "customer_history"), "customer_id", HISTORY_CHECKS, at)


def run_all(
    run: Run, first_day: str | None = None, last_day: str | None = None, now: Column | None = None, snapshot_at: str | None = None
) -> DataFrame:
    """All stages in order; returns the table test results. A failing stage or table test stops the run and is logged."""
    run_ingest(run)
    run_silver(run)
    run_quality(run, now)
    run_staging(run)
    run_source_freshness(run, F.current_timestamp())
    started = datetime.now(timezone.utc)
    outcome = run.path("audit", "table_tests") + f"/run_id={run.run_id}"
    try:
        left_out = run_gold(run, first_day, last_day)
        write_table(run_tests(run), outcome)
        results = run.spark.read.parquet(outcome)
        require_tests(results)
        run_snapshot(run, snapshot_at or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))
    except Exception:
        log_stage(run, "gold", started, "failed")
        raise
    log_stage(run, "gold", started, "success", records_failed=left_out)
    run_retention(run)
    return results
