"""Run bookkeeping and reports over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airledger.functions.temporal import (
    catchup_date,
    display_local,
    duration_seconds,
    local_wall_clock,
)

_FINISHED = 1 << 60
SCHEDULED_RUN_TYPES = ("incremental-daily", "incremental-hourly", "incremental-aqi-hourly")


def latest_run_state(runs: DataFrame, since: Column | None = None) -> DataFrame:
    """Current state of each run from its appended records: a finished record wins, of several
    the one finished last.

    All records of a run carry the same start, so ``since`` is applied to the records: older
    ones are left out by the scan. The winner is found by numbers alone (its time and a hash of
    the record), a hash aggregate that combines records before they are shuffled; the record
    is then looked up by them. Nothing is sorted, and texts are moved once.
    """
    if since is not None:
        runs = recent_runs(runs, since)
    finished = F.unix_micros("finished_at")
    started = F.unix_micros("started_at") if "started_at" in runs.columns else F.lit(0)
    # Any finish is later than any start.
    stamp = F.coalesce(finished + F.lit(_FINISHED), started, F.lit(0)).cast("long")
    marked = runs.withColumns({"_stamp": stamp, "_record": F.xxhash64(*runs.columns)})
    winners = marked.groupBy("etl_run_id").agg(
        F.max("_stamp").alias("_stamp"), F.max_by("_record", "_stamp").alias("_record")
    )
    found = marked.join(winners, ["etl_run_id", "_stamp", "_record"], "left_semi")
    # A record that was appended twice is one.
    return found.select(*runs.columns).distinct()


def recent_runs(runs: DataFrame, since: Column) -> DataFrame:
    return runs.where(F.col("started_at") >= since)


def run_report(runs: DataFrame, since: Column) -> DataFrame:
    """Runs of a window with display times and attention flags."""
    completed = F.col("status") == "completed"
    return (
        recent_runs(runs, since)
        .select(
            "etl_run_id",
            "run_type",
            "status",
            "rows_inserted",
            "rows_skipped",
            display_local(F.col("started_at")).alias("started"),
            display_local(F.col("finished_at")).alias("finished"),
            (completed & (F.col("rows_inserted") == 0)).alias("completed_empty"),
            (~completed).alias("not_completed"),
        )
        .orderBy("etl_run_id")
    )


def run_totals(runs: DataFrame, since: Column) -> DataFrame:
    """One row over the runs of a window.

    ``run_types`` lists the distinct types; their number is that of the run kinds, so the
    collected set stays small however many runs there are.
    """
    return recent_runs(runs, since).agg(
        F.count(F.lit(1)).alias("runs"),
        F.coalesce(F.sum("rows_inserted"), F.lit(0)).cast("long").alias("rows_inserted"),
        F.concat_ws(", ", F.array_sort(F.collect_set("run_type"))).alias("run_types"),
        F.min("started_at").alias("first_start"),
        F.count_if(F.col("status") != "completed").alias("not_completed"),
    )


def runs_by_type(runs: DataFrame, since: Column) -> DataFrame:
    """How many runs of a window were of which type, and what they loaded."""
    return (
        recent_runs(runs, since)
        .groupBy("run_type")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.coalesce(F.sum("rows_inserted"), F.lit(0)).cast("long").alias("rows_inserted"),
            F.count_if(F.col("status") != "completed").alias("not_completed"),
        )
    )


def catchup_needed(
    runs: DataFrame, since: Column, *, scheduled: bool, job_succeeded: bool, error: bool = False
) -> DataFrame:
    """Whether a scheduled window must be caught up, and for which date."""
    totals = recent_runs(runs, since).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") != "completed").alias("not_completed"),
    )
    trouble = (
        F.lit(not job_succeeded or error) | (F.col("not_completed") > 0) | (F.col("runs") == 0)
    )
    needed = F.lit(scheduled) & trouble
    return totals.select(
        needed.alias("needed"),
        F.when(needed, catchup_date(since).cast("string")).alias("catchup_date"),
    )


def warehouse_snapshot(
    daily: DataFrame, hourly: DataFrame, aqi: DataFrame, dim_hour: DataFrame
) -> DataFrame:
    """Rows and latest date or time per fact; ``-`` for a fact without rows."""
    hours = dim_hour.select("hour_key", "observed_at")

    def summary(label: str, df: DataFrame, latest: Column) -> DataFrame:
        return df.agg(
            F.lit(label).alias("table_label"),
            F.count(F.lit(1)).alias("total_rows"),
            F.coalesce(latest.cast("string"), F.lit("-")).alias("latest_value"),
        )

    last_hour = local_wall_clock(F.max("observed_at"))
    return (
        summary("Daily weather", daily, F.max("observed_date"))
        .unionByName(summary("Hourly weather", hourly.join(hours, "hour_key"), last_hour))
        .unionByName(summary("Hourly AQI", aqi.join(hours, "hour_key"), last_hour))
    )


def job_durations(reports: DataFrame) -> DataFrame:
    """Display times and whole-second duration of timed jobs."""
    return reports.select(
        "job_id",
        "status",
        display_local(F.col("started_at")).alias("started"),
        display_local(F.col("finished_at")).alias("finished"),
        duration_seconds(F.col("started_at"), F.col("finished_at")).alias("duration_seconds"),
    )
