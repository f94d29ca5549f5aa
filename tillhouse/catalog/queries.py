"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame.

Outputs use plain types (bigint, double, string, boolean; days and times as ISO text), so that another
engine can compare them cell by cell. The operators themselves keep dates, times and decimals.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.exprs import RANGE_DAYS, month_start, range_days, since_days
from tillhouse.operators import conform, constraints, ingest, keys, privacy, rules, upsert
from tillhouse.operators.dedup import dedup_events, dedup_latest
from tillhouse.operators.expectations import run_suite, summarize
from tillhouse.plans import checkpoints, marts, medallion, ops, serving, staging, star
from tillhouse.plans import table_tests as declared_tests
from tillhouse.schemas import CUSTOMER_TIERS
from tillhouse.session import configure_tables, materialize, scratch_path
from tillhouse.sources import driver_tables as given
from tillhouse.sources import history_table, ledger, readers, retention, versions, writers
from tillhouse.streaming import bronze as streams
from tillhouse.streaming import dedup_index, rates

Query = Callable[[SparkSession, str], DataFrame]

# The logical days the time-dependent queries run at.
EVENT_RUN_DATE = "2024-01-30"
EVENT_CLOSE = f"{EVENT_RUN_DATE} 23:59:59"
HISTORY_DATES = ("1998-01-01", "2000-01-01")
RUN_ID = "run-2024-01-30"
BRONZE_DAY = "2024-01-15"


def plain(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)


class Retail:
    """The layers over one folder of given tables, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = configure_tables(spark, [f"{sf_dir}/{name}.parquet" for name in given.RETAIL_TABLES]), sf_dir
        self.calendar: tuple[str | None, str | None] | None = None
        self.views: dict[str, DataFrame] = {}

    def stored(self, mart: str) -> DataFrame:
        """A mart that a query reads twice, as the dashboard does: written once, then queried."""
        return materialize(getattr(self, mart)(), mart)

    # Bronze ---------------------------------------------------------------------------------------

    def typed(self, name: str) -> DataFrame:
        return getattr(given, name)(self.spark, self.sf_dir)

    def bronze(self, name: str) -> DataFrame:
        table = self.typed(name)
        return table if name == "events" else given.as_bronze(table)

    # Silver ---------------------------------------------------------------------------------------

    def clear(self, name: str, text: bool = False) -> DataFrame:
        """Silver rows before masking. ``text`` starts from the text drop instead of the typed table."""
        if name == "events":
            return conform.silver_events(self.bronze("events"), EVENT_RUN_DATE)
        return conform.silver_table(self.bronze(name) if text else self.typed(name), name)

    def silver(self, name: str, text: bool = False) -> DataFrame:
        table = self.clear(name, text)
        return privacy.mask_dataframe(table) if name in ("events", "customers", "orders") else table

    # Staging and gold -----------------------------------------------------------------------------

    def staged(self, name: str) -> DataFrame:
        return staging.STAGE[name](self.silver(name))

    def view(self, name: str) -> DataFrame:
        return self.views.get(name) or staging.VIEW[name](self.staged(name))

    def store_views(self) -> None:
        """For queries that read the staging views many times, as a run does from its staging tables: each is written once."""
        for name in staging.VIEW:
            self.views[name] = materialize(self.view(name), f"stg-{name}")

    def dates(self) -> DataFrame:
        if self.calendar is None:
            self.calendar = given.calendar(self.spark, self.sf_dir)
        return star.dim_date(self.spark, *self.calendar)

    def event_dates(self) -> DataFrame:
        return star.dim_date_of(self.view("events").select(F.col("event_timestamp").cast("date").alias("day")), "day")

    def velocity(self) -> DataFrame:
        return star.inventory_velocity(self.view("orders"), self.dates())

    def dim_customers(self) -> DataFrame:
        return star.dim_customers(self.view("customers"), self.view("orders"))

    def dim_products(self) -> DataFrame:
        return star.dim_products(self.view("products"))

    def customer_keys(self) -> DataFrame:
        return keys.dense_key(self.view("customers").select("customer_id"), ["customer_id"], "customer_key")

    def product_keys(self) -> DataFrame:
        return keys.dense_key(self.view("products").select("product_id"), ["product_id"], "product_key")

    # Marts ----------------------------------------------------------------------------------------

    def sales(self) -> DataFrame:
        return marts.mart_sales_summary(self.view("orders"), self.view("customers"), self.view("products"), self.dates())

    def returns(self) -> DataFrame:
        return marts.mart_return_rates(self.view("orders"), self.view("products"), self.dates())

    def cohorts(self) -> DataFrame:
        return marts.mart_customer_cohorts(self.view("orders"), self.view("customers"), self.dates())

    def alerts(self) -> DataFrame:
        return marts.mart_inventory_alerts(self.view("inventory"), self.velocity(), self.view("products"), self.dates())

    # Audit ----------------------------------------------------------------------------------------

    def audit(self) -> DataFrame:
        """PII log of all masked tables, stamped with the day or time that each row itself carries."""
        times = {"events": "event_timestamp", "customers": "registration_date", "orders": "order_date"}
        logs = [privacy.pii_audit_rows(self.clear(name), RUN_ID, masked_at=F.col(time).cast("timestamp")) for name, time in times.items()]
        return reduce(DataFrame.unionByName, logs)

    def run_log(self) -> DataFrame:
        """One ingest row per order day: amounts above the staging limit fail, and too many fail the run."""
        daily = self.view("orders").groupBy("order_date").agg(
            F.count("*").alias("records_processed"),
            F.count_if(F.col("order_amount") > 50000).alias("records_failed"),
            F.count("card_last4").alias("pii_events_masked"),
        )
        start = F.col("order_date").cast("timestamp") + F.make_dt_interval(hours=F.lit(2))
        return daily.select(
            F.concat(F.lit("run-"), F.date_format("order_date", "yyyyMMdd")).alias("run_id"),
            F.lit("silver").alias("stage"),
            start.alias("start_time"),
            (start + F.make_dt_interval(secs=F.lit(60) + F.col("records_processed"))).alias("end_time"),
            "records_processed", "records_failed", "pii_events_masked",
            F.lit(None).cast("boolean").alias("quality_passed"),
            F.when(F.col("records_failed") * 4 > F.col("records_processed") * 3, "failed").otherwise("success").alias("status"),
        )

    def validation_log(self) -> DataFrame:
        """The four gated suites evaluated per month; customers without a first order count to January 1970."""
        days = {"events": "event_timestamp", "customers": "registration_date", "orders": "order_date", "inventory": "date"}
        never = F.lit("1970-01-01").cast("date")
        months = {n: self.silver(n).withColumn("month", F.coalesce(month_start(d), never)) for n, d in days.items()}
        results = reduce(DataFrame.unionByName, [run_suite(df, checkpoints.SUITES[n], by=["month"]) for n, df in months.items()])
        return summarize(results, by=["month"]).select(
            F.concat(F.lit("run-"), F.date_format("month", "yyyyMM")).alias("pipeline_run_id"),
            "checkpoint_name", "suite_name", "success", "evaluated_expectations", "successful_expectations",
            "unsuccessful_expectations",
            F.col("month").cast("timestamp").alias("run_time"),
        )

    # Streams --------------------------------------------------------------------------------------

    def event_stream(self) -> DataFrame:
        schema = given.read(self.spark, self.sf_dir, "events").schema
        return given.envelopes(streams.table_stream(self.spark, f"{self.sf_dir}/events.parquet", schema))

    def timed_stream(self) -> DataFrame:
        return self.event_stream().withColumn("event_timestamp", F.try_to_timestamp("event_timestamp"))

    def drain(self, stream: DataFrame, label: str) -> DataFrame:
        return streams.run_bounded(stream, scratch_path(self.spark, label), scratch_path(self.spark, f"{label}-state"))

    def panes(self) -> str:
        """Folder of the counts per pane after the stream has taken all events."""
        root = scratch_path(self.spark, "panes")
        rates.land_panes(self.timed_stream(), root, scratch_path(self.spark, "panes-state"), bounded=True).awaitTermination()
        return root

    def landed(self) -> str:
        """Bronze folder after the ingest stream has taken all messages."""
        root = scratch_path(self.spark, "bronze")
        messages = given.messages(self.event_stream())
        streams.stream_bronze(messages, root, scratch_path(self.spark, "bronze-state"), bounded=True).awaitTermination()
        return root


QUERIES: dict[str, Query] = {}


def query(f: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: plain(f(Retail(spark, sf_dir)))
    return f


# --- Bronze and ingest ----------------------------------------------------------------------------


@query
def parse_events(r: Retail) -> DataFrame:
    parsed = ingest.accepted(ingest.parse_events(given.messages(r.event_stream())))
    return r.drain(parsed, "parse").select(
        "event_id", "event_type", "event_timestamp", "order_id", "customer_id", "customer_email", "quantity", "order_amount", "status"
    )


@query
def quarantine_events(r: Retail) -> DataFrame:
    """All envelopes, the bare payloads of the events, and the documents' texts as messages of one topic: what is rejected, and why."""
    payloads = given.read(r.spark, r.sf_dir, "events").select(F.col("props").alias("value"))
    texts = given.read(r.spark, r.sf_dir, "documents").select(F.col("text").alias("value"))
    parsed = ingest.parse_events(given.messages(r.bronze("events")).unionByName(payloads).unionByName(texts))
    return ingest.quarantined(parsed).groupBy("reject_reason").agg(F.count("*").alias("messages"))


@query
def ingest_metrics(r: Retail) -> DataFrame:
    return ingest.ingest_metrics(ingest.parse_events(given.messages(r.bronze("events"))))


@query
def stream_bronze(r: Retail) -> DataFrame:
    root = r.landed()
    stored = r.spark.read.json(f"{root}/events", schema="event_id string, event_type string, date date")
    return stored.groupBy("event_type", "date").agg(F.count("*").alias("rows"), F.count_distinct("event_id").alias("event_ids"))


@query
def event_date(r: Retail) -> DataFrame:
    days = ingest.with_bronze_partition(r.bronze("events"))
    return days.groupBy("event_type", "date").agg(F.count("*").alias("rows"))


@query
def pin_event_date(r: Retail) -> DataFrame:
    timed = conform.conform(r.bronze("events"), conform.SPECS["events"])
    return ingest.pin_event_date(timed.select("event_id", "event_type", "event_timestamp"), EVENT_RUN_DATE)


@query
def stream_dedup_events(r: Retail) -> DataFrame:
    """First arrivals by a stored index of keys: the stream keeps no state."""
    out, events = scratch_path(r.spark, "dedup"), r.timed_stream()
    dedup_index.stream_dedup(events, out, scratch_path(r.spark, "dedup-index"), scratch_path(r.spark, "dedup-state"), bounded=True).awaitTermination()
    return dedup_index.deduplicated(r.spark, out, events.schema).select("event_id", "event_type", "customer_id")


@query
def stream_event_rate_5m(r: Retail) -> DataFrame:
    return rates.landed_rate_5m(r.spark, r.panes())


@query
def stream_event_rate_1h(r: Retail) -> DataFrame:
    return rates.landed_rate_1h(r.spark, r.panes())


@query
def ingest_once(r: Retail) -> DataFrame:
    drops = r.typed("inventory").select(F.date_format("date", "yyyyMM").alias("drop_id")).distinct()
    ledger = r.typed("orders").select(F.date_format("order_date", "yyyyMM").alias("drop_id")).distinct()
    return writers.ingest_once(drops, ledger)


@query
def bronze_day_events(r: Retail) -> DataFrame:
    """One day of the event folders, read by folder names from the whole Bronze layer."""
    root = scratch_path(r.spark, "events")
    ingest.with_bronze_partition(r.bronze("events")).write.partitionBy("event_type", "date").json(root)
    day = readers.read_bronze_events(r.spark, root, BRONZE_DAY)
    return day.select("event_id", "event_type", "event_timestamp", "order_id", "customer_id", "quantity", "order_amount")


@query
def bronze_csv_drop(r: Retail) -> DataFrame:
    """The orders as a CSV drop and back."""
    root = scratch_path(r.spark, "drop")
    writers.write_bronze_csv(r.bronze("orders"), root, "orders")
    return conform.silver_table(readers.read_bronze_csv(r.spark, root, "orders"), "orders").drop("shipping_address", "card_last4", "card_type")


@query
def load_drops(r: Retail) -> DataFrame:
    """The orders in drops of a year, offered twice; the ledger lets each in once."""
    root, orders = scratch_path(r.spark, "drops"), materialize(r.typed("orders"), "orders")
    year = F.date_format("order_date", "yyyy")
    drops = {y["y"]: orders.where(year == y["y"]) for y in orders.select(year.alias("y")).distinct().collect()}
    for run_id in ("first", "second"):
        ledger.load_drops(root, "orders", drops, run_id)
    inside = ledger.loaded(r.spark, root, "orders", orders.schema).groupBy(year.alias("drop_id")).agg(F.count("*").alias("rows"))
    return ledger.ledger(r.spark, root).select("entity", "drop_id", "run_id").join(inside, "drop_id")


@query
def retention_log(r: Retail) -> DataFrame:
    """What retention removed and kept of the event folders."""
    root, log = scratch_path(r.spark, "kept"), scratch_path(r.spark, "retention")
    stored = ingest.with_bronze_partition(r.bronze("events")).select("event_id", "event_type", "date")
    stored.write.partitionBy("event_type", "date").parquet(root)
    retention.remove_expired(r.spark, root, EVENT_RUN_DATE, log, RUN_ID)
    gone = versions.read_version(r.spark, log).where("removed_at IS NOT NULL")
    parts = F.split("folder", "[=/]")
    gone = gone.select(parts[1].alias("event_type"), F.col("day").alias("date"), F.lit("removed").alias("state"), F.lit(0).cast("bigint").alias("rows"))
    left = r.spark.read.parquet(root).groupBy("event_type", "date").agg(F.count("*").alias("rows"))
    return gone.unionByName(left.withColumn("state", F.lit("kept")))


@query
def expire_partitions(r: Retail) -> DataFrame:
    stored = ingest.with_bronze_partition(r.bronze("events"))
    return writers.expired_partitions(stored, EVENT_RUN_DATE)


@query
def drop_expired(r: Retail) -> DataFrame:
    stored = ingest.with_bronze_partition(r.bronze("events"))
    return writers.drop_expired(stored, EVENT_RUN_DATE).groupBy("date", "event_type").agg(F.count("*").alias("rows"))


# --- Silver ---------------------------------------------------------------------------------------


@query
def silver_events(r: Retail) -> DataFrame:
    return r.silver("events")


@query
def silver_customers(r: Retail) -> DataFrame:
    return r.silver("customers", text=True)


@query
def silver_products(r: Retail) -> DataFrame:
    return r.silver("products", text=True)


@query
def silver_orders(r: Retail) -> DataFrame:
    return r.silver("orders", text=True)


@query
def silver_inventory(r: Retail) -> DataFrame:
    return r.silver("inventory", text=True)


@query
def silver_drop_counts(r: Retail) -> DataFrame:
    counts = conform.event_drop_counts(r.bronze("events"))
    for name in ("products", "inventory"):
        counts = counts.unionByName(conform.table_drop_counts(r.bronze(name), name))
    return counts


@query
def silver_run_summary(r: Retail) -> DataFrame:
    """All five tables written as the run writes them, with the counts that the writing jobs observed."""
    root, outcome = scratch_path(r.spark, "silver"), {}
    for name in medallion.TABLES:
        outcome[name] = medallion.write_silver(r.bronze(name), name, EVENT_RUN_DATE, f"{root}/{name}", f"{root}/audit/{name}", RUN_ID)
    return medallion.run_summary(r.spark, outcome)


@query
def cast_failures(r: Retail) -> DataFrame:
    found = [conform.cast_failures(r.bronze(name), name).select(F.lit(name).alias("table_name"), "*") for name in conform.SPECS]
    return reduce(DataFrame.unionByName, found)


@query
def dedup_order_lines(r: Retail) -> DataFrame:
    lines = given.order_lines(r.spark, r.sf_dir)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query
def dedup_event_copies(r: Retail) -> DataFrame:
    typed = conform.conform(r.bronze("events"), conform.SPECS["events"])
    return dedup_events(typed).select("event_id", "event_type", "event_timestamp", "customer_id")


@query
def dedup_latest_snapshot(r: Retail) -> DataFrame:
    stock = r.silver("inventory").drop("inventory_id")
    return dedup_latest(stock, ["product_id"], "date").select("product_id", "date", "stock_level", "units_sold")


# --- privacy --------------------------------------------------------------------------------------


@query
def pii_mask_customers(r: Retail) -> DataFrame:
    masked = privacy.mask_dataframe(r.clear("customers"))
    return masked.select("customer_id", "customer_name", "hashed_email", "customer_phone", "shipping_address")


@query
def pii_mask_orders(r: Retail) -> DataFrame:
    return privacy.mask_dataframe(r.clear("orders")).select("order_id", "shipping_address", "card_last4", "card_type")


@query
def pii_audit_rows(r: Retail) -> DataFrame:
    return r.audit().drop("masked_at")


@query
def pii_masked_count(r: Retail) -> DataFrame:
    return privacy.masked_count(r.audit())


@query
def pii_log_written(r: Retail) -> DataFrame:
    """Rows per field of the PII log after a run that was written twice."""
    path, log = scratch_path(r.spark, "pii"), materialize(r.audit(), "audit")
    for _ in range(2):
        writers.write_pii_audit(log, path)
    return r.spark.read.parquet(path).groupBy("pipeline_run_id", "field_name").agg(F.count("*").alias("rows"))


@query
def pii_entities(r: Retail) -> DataFrame:
    found = r.clear("customers").select(privacy.suppression_action(F.col("shipping_address")).alias("masking_action"))
    return found.groupBy("masking_action").agg(F.count("*").alias("addresses"))


@query
def pii_scan_documents(r: Retail) -> DataFrame:
    return privacy.scan_text(given.read(r.spark, r.sf_dir, "documents"), "doc_id")


@query
def pii_redact_documents(r: Retail) -> DataFrame:
    return privacy.redact_text(given.read(r.spark, r.sf_dir, "documents")).select("doc_id", "text")


# --- staging --------------------------------------------------------------------------------------


@query
def stg_events(r: Retail) -> DataFrame:
    return r.view("events")


@query
def stg_customers(r: Retail) -> DataFrame:
    return r.view("customers")


@query
def stg_products(r: Retail) -> DataFrame:
    return r.view("products")


@query
def stg_orders(r: Retail) -> DataFrame:
    return r.view("orders")


@query
def stg_inventory(r: Retail) -> DataFrame:
    return r.view("inventory")


@query
def staging_loaded(r: Retail) -> DataFrame:
    """All staging tables loaded twice, and once more from nothing, which keeps what is there: rows, and rows with a load time."""
    root, out = scratch_path(r.spark, "staging"), None
    for name in staging.STAGE:
        rows = materialize(r.staged(name), name)
        for df in (rows, rows, rows.limit(0)):
            writers.load_staging(df, f"{root}/{name}")
        stored = r.spark.read.parquet(f"{root}/{name}").agg(F.count("*").alias("rows"), F.count("_silver_loaded_at").alias("stamped"))
        stored = stored.select(F.lit(name).alias("table_name"), "*")
        out = stored if out is None else out.unionByName(stored)
    return out


# --- gold -----------------------------------------------------------------------------------------


@query
def surrogate_keys(r: Retail) -> DataFrame:
    return r.customer_keys()


@query
def dim_customers(r: Retail) -> DataFrame:
    return r.dim_customers()


@query
def dim_products(r: Retail) -> DataFrame:
    return r.dim_products()


@query
def dim_date(r: Retail) -> DataFrame:
    return star.dim_date_of(r.view("orders"), "order_date")


@query
def date_spine(r: Retail) -> DataFrame:
    return star.dim_date_of(r.view("events").select(F.col("event_timestamp").cast("date").alias("day")), "day")


@query
def dim_geography(r: Retail) -> DataFrame:
    """The placeholder row with the facts that point to it."""
    rows = star.order_fact_rows(r.view("orders"), r.customer_keys(), r.product_keys(), r.dates())
    placed = rows.groupBy("geography_key").agg(F.count("*").alias("orders"))
    return star.dim_geography(r.spark).join(F.broadcast(placed), "geography_key", "left")


@query
def fact_orders(r: Retail) -> DataFrame:
    return star.fact_orders(r.view("orders"), r.customer_keys(), r.product_keys(), r.dates())


@query
def fact_events(r: Retail) -> DataFrame:
    return star.fact_events(r.view("events"), r.customer_keys(), r.product_keys(), r.event_dates())


@query
def fact_inventory_snapshots(r: Retail) -> DataFrame:
    return star.fact_inventory_snapshots(r.view("inventory"), r.velocity(), r.product_keys(), r.dates())


@query
def inventory_velocity(r: Retail) -> DataFrame:
    return r.velocity()


@query
def scd2_customers(r: Retail) -> DataFrame:
    """History of all customers with their totals before each of two days, from orders that are read once."""
    progressed = F.col("status") != "placed"
    before = [progressed & (F.col("order_date") < F.lit(day).cast("date")) for day in HISTORY_DATES]
    sums = [f for i, test in enumerate(before) for f in (F.count_if(test).alias(f"n{i}"), F.sum(F.when(test, F.col("order_amount"))).alias(f"s{i}"))]
    totals = r.view("orders").groupBy("customer_id").agg(*sums)
    rows = materialize(r.view("customers").join(totals, "customer_id", "left"), "totals")
    root = scratch_path(r.spark, "history")
    for i, day in enumerate(HISTORY_DATES):
        current = rows.select(
            "customer_id", "hashed_email", "tier", "registration_date",
            F.coalesce(f"n{i}", F.lit(0)).alias("total_orders"),
            F.coalesce(f"s{i}", F.lit(0).cast("decimal(22,2)")).alias("total_spent"),
        )
        history_table.snapshot(current, root, "customer_id", ("tier", "total_spent", "total_orders"), day)
    return history_table.read_history(r.spark, root)


@query
def upsert_by_key(r: Retail) -> DataFrame:
    """The run log after the quality stage has set its verdict for every run that processed anything but failures."""
    log = r.run_log()
    judged = log.where(F.col("records_failed") < F.col("records_processed"))
    verdicts = judged.select("run_id", (F.col("records_failed") * 2 <= F.col("records_processed")).alias("quality_passed"), F.lit("quality").alias("stage"))
    return upsert.upsert_by_key(log, verdicts, ["run_id"], ["quality_passed"])


@query
def backfill_customer_stats(r: Retail) -> DataFrame:
    done = star.backfill_customer_stats(r.clear("customers"), r.view("orders"))
    return done.select("customer_id", "tier", "total_orders", "total_spent")


@query
def backfill_current_stock(r: Retail) -> DataFrame:
    done = star.backfill_current_stock(r.view("products"), r.silver("inventory"))
    return done.select("product_id", "current_stock")


# --- marts ----------------------------------------------------------------------------------------


@query
def mart_sales_summary(r: Retail) -> DataFrame:
    return r.sales()


@query
def mart_return_rates(r: Retail) -> DataFrame:
    return r.returns()


@query
def mart_customer_cohorts(r: Retail) -> DataFrame:
    return r.cohorts()


@query
def mart_event_cohorts(r: Retail) -> DataFrame:
    """The cohort mart on the event stream: registration events against the weeks of order events."""
    events = r.silver("events").select("customer_id", F.col("event_timestamp").cast("date").alias("day"), "event_type")
    joined = conform.conform(r.bronze("events"), conform.SPECS["events"]).where(F.col("event_type") == "customer_registered")
    members = joined.groupBy("customer_id").agg(F.max(F.col("event_timestamp").cast("date")).alias("registration_date"))
    orders = events.where(F.col("event_type") == "order_placed").select("customer_id", F.col("day").alias("order_date"))
    return marts.mart_customer_cohorts(orders, members, r.event_dates())


@query
def mart_inventory_alerts(r: Retail) -> DataFrame:
    return r.alerts()


# --- serving --------------------------------------------------------------------------------------


@query
def daily_sales_trend(r: Retail) -> DataFrame:
    sales = r.stored("sales")
    return serving.daily_sales_trend(sales, 30, as_of=serving.latest(sales, "period_date"))


@query
def range_presets(r: Retail) -> DataFrame:
    """Orders and GMV inside every preset of the date range, up to the newest day."""
    sales = r.stored("sales")
    newest = serving.latest(sales, "period_date")
    sums = []
    for preset in RANGE_DAYS:
        inside = sales.where(F.col("period_date") >= since_days(newest, range_days(preset)))
        sums.append(inside.agg(F.sum("total_orders").alias("orders"), F.sum("total_gmv").alias("gmv")).select(F.lit(preset).alias("preset"), "*"))
    return reduce(DataFrame.unionByName, sums)


@query
def sales_by_category(r: Retail) -> DataFrame:
    sales = r.stored("sales")
    return serving.sales_by_category(sales, 90, as_of=serving.latest(sales, "period_date"))


@query
def home_kpis(r: Retail) -> DataFrame:
    return serving.home_kpis(r.stored("sales"), r.stored("alerts"))


@query
def cohort_table(r: Retail) -> DataFrame:
    return serving.cohort_table(r.cohorts())


@query
def cohort_heatmap(r: Retail) -> DataFrame:
    return serving.cohort_heatmap(r.stored("cohorts"))


@query
def cohort_bands(r: Retail) -> DataFrame:
    return serving.cohort_bands(r.cohorts())


@query
def customer_tier_summary(r: Retail) -> DataFrame:
    return serving.customer_tier_summary(star.customer_rows(r.view("customers"), r.view("orders")))


@query
def inventory_alerts_filtered(r: Retail) -> DataFrame:
    return serving.inventory_alerts_filtered(r.alerts(), level="red", category="PROMO", search="RING")


@query
def inventory_alerts_sorted(r: Retail) -> DataFrame:
    return serving.inventory_alerts_filtered(r.alerts(), search="bolt", sort_by="days_of_stock_remaining", descending=True)


@query
def inventory_stats(r: Retail) -> DataFrame:
    return serving.inventory_stats(r.alerts())


@query
def return_trends(r: Retail) -> DataFrame:
    returns = r.stored("returns")
    return serving.return_trends(returns, 6, as_of=serving.latest(returns, "period_date"))


@query
def returns_by_category(r: Retail) -> DataFrame:
    returns = r.stored("returns")
    return serving.returns_by_category(returns, 90, as_of=serving.latest(returns, "period_date"))


@query
def top_returned_products(r: Retail) -> DataFrame:
    return serving.top_returned_products(r.stored("returns"))


@query
def latest_return_kpi(r: Retail) -> DataFrame:
    return serving.latest_return_kpi(r.stored("returns"))


@query
def paged(r: Retail) -> DataFrame:
    """Second page of the products."""
    return serving.paged(r.view("products").select("product_id", "product_name"), "product_id", page=1)


@query
def paged_seek(r: Retail) -> DataFrame:
    """Second page of the products, continued behind the last key of the first on a table stored in key order."""
    stored = serving.store_sorted(r.view("products").select("product_id", "product_name"), scratch_path(r.spark, "pages"), "product_id")
    last = serving.page_after(stored, "product_id").agg(F.max("product_id")).first()[0]
    return serving.page_after(stored, "product_id", last)


# --- data quality ---------------------------------------------------------------------------------


def _suite(name: str) -> Callable[[Retail], DataFrame]:
    def run(r: Retail) -> DataFrame:
        return run_suite(r.silver(name), checkpoints.SUITES[name])

    run.__name__ = f"expect_{name}"
    return query(run)


for _name in checkpoints.SUITES:
    _suite(_name)


@query
def checkpoint_summary(r: Retail) -> DataFrame:
    results = checkpoints.run_checkpoints({name: r.silver(name) for name in checkpoints.GATED_TABLES})
    return checkpoints.checkpoint_summary(results, checkpoints.freshness_check(r.silver("events"), F.lit(EVENT_CLOSE)))


@query
def validation_written(r: Retail) -> DataFrame:
    """The validation log after a run that was written twice, and which rows close the gate."""
    path = scratch_path(r.spark, "validation")
    results = materialize(checkpoints.run_checkpoints({name: r.silver(name) for name in checkpoints.GATED_TABLES}), "results")
    fresh = checkpoints.freshness_check(r.silver("events"), F.lit(EVENT_CLOSE))
    for _ in range(2):
        writers.write_validation(checkpoints.validation_rows(results, RUN_ID, fresh), path)
    log = r.spark.read.parquet(path)
    return log.select(
        "pipeline_run_id", "checkpoint_name", "suite_name", "evaluated_expectations", "successful_expectations", "unsuccessful_expectations",
        (~F.col("success")).alias("closes_gate"), F.col("result_detail").isNotNull().alias("detailed"),
    )


@query
def freshness_check(r: Retail) -> DataFrame:
    return checkpoints.freshness_check(r.silver("events"), F.lit(EVENT_CLOSE))


@query
def source_freshness(r: Retail) -> DataFrame:
    """Age of the newest row of each staging table at the end of the last event day."""
    at = {"events": "event_timestamp", "orders": "order_date", "customers": "registered_at", "inventory": "snapshot_date"}
    loaded = {name: r.staged(name).select(F.col(c).alias("_silver_loaded_at")) for name, c in at.items()}
    # a product carries no time: the last snapshot that lists it
    listed = r.staged("inventory").join(r.staged("products").select("product_id"), "product_id", "left_semi")
    loaded["products"] = listed.select(F.col("snapshot_date").alias("_silver_loaded_at"))
    return checkpoints.source_freshness(loaded, F.lit(EVENT_CLOSE))


@query
def test_not_null(r: Retail) -> DataFrame:
    return rules.test_not_null(r.silver("customers"), "tier").select("customer_id", "hashed_email")


@query
def test_unique(r: Retail) -> DataFrame:
    return rules.test_unique(given.read(r.spark, r.sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query
def test_accepted_values(r: Retail) -> DataFrame:
    return rules.test_accepted_values(r.bronze("customers"), "tier", *CUSTOMER_TIERS)


@query
def test_relationships(r: Retail) -> DataFrame:
    """Order heads without a line."""
    heads, lines = given.read(r.spark, r.sf_dir, "orders"), given.read(r.spark, r.sf_dir, "lineitem")
    return rules.test_relationships(heads, "o_orderkey", lines, "l_orderkey").select("o_orderkey", "o_orderstatus")


@query
def table_tests(r: Retail) -> DataFrame:
    """Every declared test over staging, dimensions, facts and marts; tables that several tests read are stored once."""
    names = ("customers", "products", "orders", "inventory", "events")
    r.store_views()
    tables = {f"stg_{n}": r.view(n) for n in names} | {"dim_date": r.dates()}
    tables["dim_customers"], tables["dim_products"] = r.dim_customers(), r.dim_products()
    keyed = (tables["dim_customers"], tables["dim_products"], r.dates())
    tables["fact_orders"] = star.fact_orders(r.view("orders"), *keyed)
    tables["fact_events"] = star.fact_events(r.view("events"), *keyed)
    tables["fact_inventory_snapshots"] = star.fact_inventory_snapshots(r.view("inventory"), r.velocity(), *keyed[1:])
    marts_ = {"mart_sales_summary": "sales", "mart_return_rates": "returns", "mart_customer_cohorts": "cohorts", "mart_inventory_alerts": "alerts"}
    tables |= {name: r.stored(build) for name, build in marts_.items()}
    return rules.run_table_tests(tables, **declared_tests.for_tables(tables))


@query
def staging_constraints(r: Retail) -> DataFrame:
    return rules.staging_constraints({name: r.staged(name) for name in staging.STAGE} | {"run_log": r.run_log()})


@query
def constraint_loads(r: Retail) -> DataFrame:
    """Every staging table loaded whole, after the rows with an even number were loaded before: what gets in, and what does not and why."""
    numbered = {"events": "event_id", "customers": "customer_id", "products": "product_id", "orders": "order_line_id", "inventory": "product_id"}
    out = None
    for name, key in numbered.items():
        rows = materialize(r.staged(name), name)
        even = F.regexp_extract(key, "[0-9]+$", 0).cast("bigint") % 2 == 0
        done = constraints.enforce(rows, name, before=rows.where(even))
        counts = done.loaded.agg(F.lit("loaded").alias("rule"), F.count("*").alias("rows")).unionByName(done.counts())
        counts = counts.select(F.lit(name).alias("table_name"), "rule", "rows")
        out = counts if out is None else out.unionByName(counts)
    return out


@query
def assert_gmv_positive(r: Retail) -> DataFrame:
    return rules.assert_gmv_positive(r.view("orders")).select("order_id", "order_amount")


@query
def assert_reorder_matches(r: Retail) -> DataFrame:
    return rules.assert_reorder_matches(r.view("inventory"), r.view("products"))


@query
def assert_no_future_orders(r: Retail) -> DataFrame:
    late = rules.assert_no_future_orders(r.view("orders"), as_of=F.lit("2001-07-01").cast("date"))
    return late.select("order_id", "order_date")


@query
def assert_amount_matches(r: Retail) -> DataFrame:
    return rules.assert_amount_matches(r.view("orders")).select("order_id", "order_amount", "quantity", "unit_price")


# --- operations -----------------------------------------------------------------------------------


@query
def run_view(r: Retail) -> DataFrame:
    log = r.run_log()
    second = log.select(
        "run_id", F.lit("staging").alias("stage"), F.col("end_time").alias("start_time"),
        (F.col("end_time") + F.make_dt_interval(secs=F.lit(30))).alias("end_time"),
        (F.col("records_processed") - F.col("records_failed")).alias("records_processed"),
        F.lit(0).cast("bigint").alias("records_failed"), F.lit(0).cast("bigint").alias("pii_events_masked"),
        (F.col("records_failed") == 0).alias("quality_passed"), F.lit("success").alias("status"),
    )
    return ops.run_view(log.unionByName(second))


@query
def recent_runs(r: Retail) -> DataFrame:
    return ops.recent_runs(r.run_log(), 50).drop("quality_passed")


@query
def last_success(r: Retail) -> DataFrame:
    return ops.last_success(r.run_log()).drop("quality_passed")


@query
def today_totals(r: Retail) -> DataFrame:
    log = r.run_log()
    return ops.today_totals(log, as_of=log.select(F.max("start_time").cast("date")).scalar())


@query
def run_stats(r: Retail) -> DataFrame:
    return ops.run_stats(r.run_log(), 100)


@query
def runs_by_day_status(r: Retail) -> DataFrame:
    return ops.runs_by_day_status(r.run_log())


@query
def validation_results(r: Retail) -> DataFrame:
    return ops.validation_results(r.validation_log(), n=20)


@query
def failed_validations(r: Retail) -> DataFrame:
    return ops.validation_results(r.validation_log(), failed_only=True, n=50)


@query
def checkpoint_status(r: Retail) -> DataFrame:
    return ops.checkpoint_status(r.validation_log())


@query
def pass_rate_trend(r: Retail) -> DataFrame:
    return ops.pass_rate_trend(r.validation_log())


@query
def panel_totals(r: Retail) -> DataFrame:
    return ops.panel_totals(r.validation_log(), r.run_log())


@query
def pii_summary(r: Retail) -> DataFrame:
    return ops.pii_summary(r.audit())


@query
def pii_totals(r: Retail) -> DataFrame:
    return ops.pii_totals(r.audit())


@query
def pii_hourly_volume(r: Retail) -> DataFrame:
    return ops.pii_hourly_volume(r.audit(), 7, as_of=F.lit(f"{EVENT_RUN_DATE} 12:00:00").cast("timestamp"))


@query
def recent_pii_events(r: Retail) -> DataFrame:
    return ops.recent_pii_events(r.audit(), 200)


@query
def event_rate_5m(r: Retail) -> DataFrame:
    return ops.event_rate_5m(conform.conform(r.bronze("events"), conform.SPECS["events"]))


@query
def event_rate_1h(r: Retail) -> DataFrame:
    return ops.event_rate_1h(conform.conform(r.bronze("events"), conform.SPECS["events"]))


@query
def pii_rate_1h(r: Retail) -> DataFrame:
    return ops.pii_rate_1h(r.audit())


@query
def throughput_in_out(r: Retail) -> DataFrame:
    received = conform.conform(r.bronze("events"), conform.SPECS["events"])
    return ops.throughput_in_out(received, r.silver("events"))
