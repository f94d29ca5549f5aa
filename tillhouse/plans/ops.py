"""Operations queries over the run log, the validation log, the PII log and the event stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# --- runs -----------------------------------------------------------------------------------------


def run_view(log: DataFrame) -> DataFrame:
    """One row per run out of its stage rows: first start, last end, summed counts, worst status."""
    status = (
        F.when(F.count_if(F.col("status") == "failed") > 0, "failed")
        .when(F.count_if(F.col("status") == "running") > 0, "running")
        .otherwise("success")
    )
    return log.groupBy("run_id").agg(
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("records_processed").alias("records_processed"),
        F.sum("records_failed").alias("records_failed"),
        F.every("quality_passed").alias("quality_passed"),
        F.sum("pii_events_masked").alias("pii_events_masked"),
        status.alias("status"),
    )


def recent_runs(runs: DataFrame, n: int = 50) -> DataFrame:
    return runs.orderBy(F.col("start_time").desc(), "run_id").limit(n)


def last_success(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("status") == "success").orderBy(F.col("end_time").desc(), "run_id").limit(1)


def today_totals(runs: DataFrame, as_of: Column | None = None) -> DataFrame:
    day = F.current_date() if as_of is None else as_of
    zero = F.lit(0).cast("bigint")
    return runs.where(F.col("start_time").cast("date") == day).agg(
        F.coalesce(F.sum("records_processed"), zero).alias("records_processed_today"),
        F.coalesce(F.sum("pii_events_masked"), zero).alias("pii_events_masked_today"),
    )


def run_durations(runs: DataFrame) -> DataFrame:
    seconds = (F.unix_micros("end_time") - F.unix_micros("start_time")) / 1e6
    return runs.withColumn("duration_seconds", seconds).withColumn("run_date", F.col("start_time").cast("date"))


def run_stats(runs: DataFrame, n: int = 100) -> DataFrame:
    """Success and failure counts and mean duration of the last ``n`` runs."""
    shown = run_durations(recent_runs(runs, n))
    return shown.agg(
        F.count_if(F.col("status") == "success").alias("success_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.avg("duration_seconds").alias("avg_duration_seconds"),
    )


def runs_by_day_status(runs: DataFrame) -> DataFrame:
    return run_durations(runs).groupBy("run_date", "status").agg(F.count("*").alias("runs"))


# --- validation -----------------------------------------------------------------------------------


def validation_results(log: DataFrame, run_id: str | None = None, failed_only: bool = False, n: int = 500) -> DataFrame:
    """Newest validation rows, or all rows of one run in time order."""
    rows = log.where(F.col("pipeline_run_id") == run_id) if run_id else log
    rows = rows.where(~F.col("success")) if failed_only else rows
    shown = rows.select(
        F.col("pipeline_run_id").alias("run_id"), "checkpoint_name", "suite_name", "success",
        "evaluated_expectations", "successful_expectations",
        F.col("unsuccessful_expectations").alias("failed_expectations"), "run_time",
    )
    if run_id:
        return shown.orderBy("run_time", "checkpoint_name")
    return shown.orderBy(F.col("run_time").desc(), "run_id", "checkpoint_name").limit(n)


def checkpoint_status(log: DataFrame) -> DataFrame:
    """Per checkpoint: passed runs, all runs, time of the last pass."""
    return log.groupBy("checkpoint_name").agg(
        F.count_if("success").alias("passed"),
        F.count("*").alias("total"),
        F.max(F.when(F.col("success"), F.col("run_time"))).alias("last_success"),
    )


def pass_rate_trend(log: DataFrame) -> DataFrame:
    """Share of passed expectations per checkpoint run; null when none was evaluated."""
    rate = F.try_divide(F.col("successful_expectations").cast("double"), F.col("evaluated_expectations"))
    return log.select("run_time", "checkpoint_name", rate.alias("pass_rate")).orderBy("run_time", "checkpoint_name")


def panel_totals(log: DataFrame, runs: DataFrame) -> DataFrame:
    """Totals of the monitoring panels as (panel, label, value)."""
    label = F.col("checkpoint_name").alias("label")
    by_checkpoint = log.groupBy(label).agg(
        F.sum(F.col("success").cast("double")).alias("checkpoints_passing"),
        F.sum("successful_expectations").cast("double").alias("expectations_passed"),
        F.sum("unsuccessful_expectations").cast("double").alias("expectations_failed"),
    )
    by_stage = run_durations(runs).groupBy(F.col("stage").alias("label")).agg(
        F.sum("records_processed").cast("double").alias("rows_processed"),
        F.sum("records_failed").cast("double").alias("rows_failed"),
        F.max("duration_seconds").alias("max_duration_seconds"),
    )
    long = lambda df: df.unpivot("label", [c for c in df.columns if c != "label"], "panel", "value")
    return long(by_checkpoint).unionByName(long(by_stage)).select("panel", "label", "value")


# --- PII log --------------------------------------------------------------------------------------


def pii_summary(audit: DataFrame) -> DataFrame:
    """Per field: masked values, last time, mean length of the original; most frequent first."""
    return audit.groupBy("field_name").agg(
        F.count("*").alias("events"),
        F.max("masked_at").alias("last_seen"),
        F.avg("original_length").alias("avg_original_length"),
    ).orderBy(F.col("events").desc(), "field_name")


def pii_totals(audit: DataFrame) -> DataFrame:
    """One row: masked fields and masked values over all fields."""
    per_field = audit.groupBy("field_name").agg(F.count("*").alias("n"))
    return per_field.agg(F.count("*").alias("fields_masked"), F.coalesce(F.sum("n"), F.lit(0)).alias("events_masked"))


def pii_hourly_volume(audit: DataFrame, days: int = 7, as_of: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    recent = audit.where(F.col("masked_at") > now - F.make_dt_interval(F.lit(days)))
    return recent.groupBy(F.date_trunc("hour", "masked_at").alias("hour")).agg(F.count("*").alias("events")).orderBy("hour")


def recent_pii_events(audit: DataFrame, n: int = 200) -> DataFrame:
    shown = audit.select(
        "record_id", "event_id", "field_name", "masking_action", "original_length", "pipeline_run_id", "masked_at"
    )
    return shown.orderBy(F.col("masked_at").desc(), "record_id", "field_name").limit(n)


# --- rates ----------------------------------------------------------------------------------------


def window_rate(df: DataFrame, time: str, length: str, seconds: int, by: tuple[str, ...] = (), slide: str | None = None) -> DataFrame:
    """Rows per second in every window, per group. Works on batch and on streaming frames.

    Sliding windows are summed from panes as long as the slide, so that a row is counted once instead of
    being copied into every window that covers it.
    """
    panes = df.groupBy(F.window(time, slide or length).alias("w"), *by).agg(F.count("*").alias("events"))
    if slide:
        spans = F.window(F.window_time("w"), length, slide)
        panes = panes.groupBy(spans.alias("w"), *by).agg(F.sum("events").alias("events"))
    return panes.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "events",
        (F.col("events") / F.lit(float(seconds))).alias("per_second"),
    )


def pane_counts(df: DataFrame, time: str, length: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows per pane and group, as ``pane_start, events``; counts of the same pane may be added up later."""
    panes = df.groupBy(F.window(time, length).alias("w"), *by).agg(F.count("*").alias("events"))
    return panes.select(F.col("w.start").alias("pane_start"), *by, "events")


def pane_rate(panes: DataFrame, length: str, seconds: int, by: tuple[str, ...] = (), slide: str | None = None) -> DataFrame:
    """``window_rate`` from counts per pane, where a pane is no longer than the slide and divides it."""
    spans = F.window("pane_start", length, slide or length)
    sums = panes.groupBy(spans.alias("w"), *by).agg(F.sum("events").alias("events"))
    return sums.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "events",
        (F.col("events") / F.lit(float(seconds))).alias("per_second"),
    )


def event_rate_5m(events: DataFrame, time: str = "event_timestamp") -> DataFrame:
    return window_rate(events, time, "5 minutes", 300, ("event_type",))


def event_rate_1h(events: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """Hourly rate, sliding by five minutes."""
    return window_rate(events, time, "1 hour", 3600, ("event_type",), slide="5 minutes")


def pii_rate_1h(audit: DataFrame) -> DataFrame:
    return window_rate(audit, "masked_at", "1 hour", 3600, slide="5 minutes")


def throughput_in_out(received: DataFrame, stored: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """Events in and records out per hour. One grouped pass over both, tagged by side."""
    side = lambda df, incoming: df.select(F.col(time).alias("at"), F.lit(incoming).alias("incoming"))
    both = side(received, True).unionByName(side(stored, False))
    hourly = both.groupBy(F.window("at", "1 hour").alias("w")).agg(
        F.count_if("incoming").alias("events_in"), F.count_if(~F.col("incoming")).alias("records_out")
    )
    return hourly.select(
        F.col("w.start").alias("window_start"), "events_in", "records_out",
        (F.col("events_in") / F.lit(3600.0)).alias("in_per_second"),
        (F.col("records_out") / F.lit(3600.0)).alias("out_per_second"),
    )
