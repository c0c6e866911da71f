"""The data behind a workflow report."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airledger.operators.monitoring import (
    catchup_needed,
    latest_run_state,
    run_report,
    run_totals,
    runs_by_type,
    warehouse_snapshot,
)
from airledger.schemas import DIM_HOUR, FACT_AQI, FACT_DAILY, FACT_HOURLY
from airledger.sinks.warehouse import Warehouse
from airledger.sources.files import read_job_reports


@dataclass(frozen=True)
class WorkflowReport:
    runs: DataFrame
    totals: DataFrame
    types: DataFrame
    snapshot: DataFrame
    catchup: DataFrame
    jobs: DataFrame | None


def workflow_report(
    warehouse: Warehouse,
    since: datetime,
    *,
    job_reports: str | None = None,
    scheduled: bool = True,
    job_succeeded: bool = True,
) -> WorkflowReport:
    """Frames for the runs since a moment. Job reports, when given, can move it earlier or
    later: the oldest job start is then what counts."""
    jobs = None
    moment = F.lit(since)
    if job_reports is not None:
        jobs = read_job_reports(warehouse.spark, job_reports)
        oldest = jobs.agg(F.min(F.to_timestamp("started_at_utc"))).first()[0]
        moment = F.lit(oldest) if oldest is not None else moment
    runs = latest_run_state(warehouse.monitoring("etl_runs"), moment)
    return WorkflowReport(
        runs=run_report(runs, moment),
        totals=run_totals(runs, moment),
        types=runs_by_type(runs, moment),
        snapshot=warehouse_snapshot(
            warehouse.table(FACT_DAILY),
            warehouse.table(FACT_HOURLY),
            warehouse.table(FACT_AQI),
            warehouse.table(DIM_HOUR),
        ),
        catchup=catchup_needed(
            runs, moment, scheduled=scheduled, job_succeeded=job_succeeded
        ),
        jobs=jobs,
    )
