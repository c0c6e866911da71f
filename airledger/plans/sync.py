"""Incremental copy of one warehouse into another."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.functions.temporal import month_key, month_of_date_key
from airledger.operators.merge import PARTITION_COLUMN
from airledger.operators.sync import local_marks, sync_delta, watermarks
from airledger.schemas import DIM_DATE, DIM_DISTRICT, DIM_HOUR, TABLE_SPECS, TableSpec
from airledger.session import Staging, staging
from airledger.sinks.warehouse import Warehouse


@dataclass(frozen=True)
class SyncResult:
    table: str
    rows_read: int
    rows_upserted: int


def sync_warehouses(
    source: Warehouse,
    target: Warehouse,
    *,
    lookback_days: int = 0,
    full: bool = False,
    now: datetime | None = None,
) -> list[SyncResult]:
    """Copy new and recent rows table by table, dimensions first.

    A changed old row is noticed only when its date lies at or after ``now - lookback_days``
    or with ``full``.
    """
    if lookback_days < 0:
        raise ValueError("lookback_days must not be negative")
    if source.root == target.root:
        raise ValueError("source and target must be different warehouses")
    moment = datetime.now(timezone.utc) if now is None else now
    if moment.tzinfo is None:
        raise ValueError("now must carry a time zone")
    cutoff = moment - timedelta(days=lookback_days)
    return [_sync_table(source, target, spec, cutoff, full) for spec in TABLE_SPECS]


def sync_summary(spark: SparkSession, results: list[SyncResult]) -> DataFrame:
    """One row per table of a sync."""
    return spark.createDataFrame(
        [(r.table, r.rows_read, r.rows_upserted) for r in results],
        "name string, rows_read bigint, rows_upserted bigint",
    )


def sync_totals(results: list[SyncResult]) -> dict[str, int]:
    return {
        "rows_read": sum(r.rows_read for r in results),
        "rows_upserted": sum(r.rows_upserted for r in results),
    }


def _sync_table(
    source: Warehouse, target: Warehouse, spec: TableSpec, cutoff: datetime, full: bool
) -> SyncResult:
    with staging(source.spark, "sync") as stage:
        rows = source.physical(spec)
        marks = None
        if not (full or spec.always_full) and target.exists(spec):
            marks = watermarks(target.table(spec), spec)
            if spec.district_column is not None:
                marks = local_marks(target.table(DIM_DISTRICT), marks)
            marks = stage.put(marks, "marks")
            if spec.partitioned:
                lowest = marks.agg(F.min("last_key")).first()[0]
                rows = _prune(source, spec, rows, -1 if lowest is None else lowest, cutoff)
        delta = stage.put(
            sync_delta(
                rows,
                spec,
                marks,
                cutoff,
                dim_hour=source.table(DIM_HOUR),
                full=full,
            ),
            "delta",
        )
        count = delta.count()
        if count:
            target.upsert(spec, delta, keep_absent=True)
        return SyncResult(spec.name, count, count)


def _prune(
    source: Warehouse, spec: TableSpec, rows: DataFrame, lowest: int, cutoff: datetime
) -> DataFrame:
    """Keep only the partitions that can hold an admissible row.

    Such a row has a key above the lowest mark or a date at or after the cutoff. Which
    months that concerns is read from the calendar or hour dimension, not from the fact.
    """
    day = F.lit(cutoff.astimezone(timezone.utc).date())
    if spec.cutoff_via_hour:
        dimension = source.table(DIM_HOUR)
        admissible = (F.col("hour_key") > lowest) | (F.col("observed_at") >= F.lit(cutoff))
        month: Column = month_key(F.col("observed_date"))
    else:
        dimension = source.table(DIM_DATE)
        admissible = (F.col("date_key") > lowest) | (F.col("date") >= day)
        month = month_of_date_key(F.col("date_key"))
    listed = dimension.where(admissible).select(month.alias("month")).distinct()
    months = [row[0] for row in listed.collect()]
    return rows.where(F.col(PARTITION_COLUMN).isin(months))
