"""Jobs that chain runs: catch-up after a failed schedule, and range backfills."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from airledger.operators.calendar import CALENDAR_START
from airledger.operators.monitoring import SCHEDULED_RUN_TYPES
from airledger.plans.etl import RunResult, ensure_dates, run_etl, seed_districts
from airledger.plans.release import publish
from airledger.sinks.release_files import ReleaseStore
from airledger.sinks.warehouse import Warehouse


def catch_up(
    warehouse: Warehouse,
    landing: DataFrame,
    start: date,
    end: date,
    *,
    store: ReleaseStore | None = None,
    source: str = "warehouse",
    districts: DataFrame | None = None,
    run_types: Sequence[str] = SCHEDULED_RUN_TYPES,
) -> tuple[list[RunResult], dict | None]:
    """Seed, run, then republish and verify the window.

    Publishing needs all scheduled kinds to have run, because a release whose facts reach
    different dates is refused.
    """
    if districts is not None:
        seed_districts(warehouse, districts)
    ensure_dates(warehouse, min(CALENDAR_START, start), end)
    results = [run_etl(warehouse, landing, r, start=start, end=end) for r in run_types]
    if store is None or set(run_types) != set(SCHEDULED_RUN_TYPES):
        return results, None
    manifest = publish(warehouse, store, source, start=start, end=end, force=True)
    store.verify(manifest)
    return results, manifest


def backfill_hourly(
    warehouse: Warehouse,
    landing: DataFrame,
    start: date,
    end: date,
    *,
    district_ids: Sequence[int] | None = None,
    first: int | None = None,
    store: ReleaseStore | None = None,
    source: str = "warehouse",
) -> tuple[RunResult, dict | None]:
    """Re-run the hourly load over a range, filling measures added since, and republish."""
    if start > end:
        raise ValueError("start must be before or equal to end")
    result = run_etl(
        warehouse, landing, "historical-hourly",
        start=start, end=end, district_ids=district_ids, first=first,
    )
    if store is None:
        return result, None
    return result, publish(warehouse, store, source, start=start, end=end, force=True)
