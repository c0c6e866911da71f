"""Filtered, paged and aggregated reads over the star schema."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airledger.functions.temporal import local_date
from airledger.operators.merge import PARTITION_COLUMN
from airledger.schemas import TableSpec

DEFAULT_PAGE = 100
MAX_PAGE = 1000
DAILY_ORDER = ("observed_date", "district_id")


def _month(day: date) -> int:
    return day.year * 100 + day.month


def _in_months(fact: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Partition predicate implied by a date range.

    A join on the hour dimension cannot prune fact files by itself, so the same bound is
    also put on the partition column when the table is read with it.
    """
    if PARTITION_COLUMN not in fact.columns:
        return fact
    if start is not None:
        fact = fact.where(F.col(PARTITION_COLUMN) >= _month(start))
    if end is not None:
        fact = fact.where(F.col(PARTITION_COLUMN) <= _month(end))
    return fact


def _prune_months(fact: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """As ``_in_months``; the column itself is physical and does not show in results."""
    return _in_months(fact, start, end).drop(PARTITION_COLUMN)


def _date_filter(
    df: DataFrame, start: date | None, end: date | None, column: str = "observed_date"
) -> DataFrame:
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    return df


def filter_daily(
    fact: DataFrame, district_id: int | None, start: date | None, end: date | None
) -> DataFrame:
    if district_id is not None:
        fact = fact.where(F.col("district_id") == district_id)
    return _date_filter(_prune_months(fact, start, end), start, end)


def daily_range(
    fact: DataFrame,
    district_id: int | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Daily rows by date, then district; bounds inclusive and each optional."""
    return filter_daily(fact, district_id, start, end).orderBy(*DAILY_ORDER)


def daily_statistics(
    fact: DataFrame,
    district_id: int | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Always one row, echoing the filters; measures are null when nothing matches."""
    return filter_daily(fact, district_id, start, end).agg(
        F.lit(district_id).cast("int").alias("district_id"),
        F.lit(start).cast("date").alias("start_date"),
        F.lit(end).cast("date").alias("end_date"),
        F.avg("temperature_2m_mean").alias("avg_temperature_2m_mean"),
        F.max("temperature_2m_max").alias("max_temperature_2m_max"),
        F.min("temperature_2m_min").alias("min_temperature_2m_min"),
        F.sum("precipitation_sum").alias("total_precipitation_sum"),
    )


def with_hours(
    fact: DataFrame, dim_hour: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Hourly fact joined to the hours inside a date range.

    The dimension is filtered first; it is a file-backed table of a few rows per day, so
    Spark broadcasts it by its known size.
    """
    hours = _date_filter(dim_hour, start, end).select("hour_key", "observed_date", "observed_at")
    return _prune_months(fact, start, end).join(hours, "hour_key")


def hourly_range(
    fact: DataFrame,
    dim_hour: DataFrame,
    district_id: int | None = None,
    start: date | None = None,
    end: date | None = None,
    limit: int = DEFAULT_PAGE,
    offset: int = 0,
    *,
    by_counts: bool = False,
) -> DataFrame:
    """One page of hourly rows by instant, then district.

    A page is a top-k of ``offset + limit`` rows; with ``by_counts`` it is located by
    ``deep_page``, which suits large offsets. Both give the same rows.
    """
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    if district_id is not None:
        fact = fact.where(F.col("district_id") == district_id)
    rows = with_hours(fact, dim_hour, start, end)
    if by_counts:
        return deep_page(rows, limit, offset, lambda lo, hi: with_hours(fact, dim_hour, lo, hi))
    return rows.orderBy("observed_at", "district_id").offset(offset).limit(limit)


def deep_page(
    rows: DataFrame,
    limit: int,
    offset: int,
    between: Callable[[date, date], DataFrame] | None = None,
) -> DataFrame:
    """The same page without keeping every skipped row in one place.

    Rows are counted per instant; running totals over those counts (one row per hour) show
    which instants the page touches, as many as it has rows at most. Only their days are read
    again, through ``between`` if that can prune them, and ranked. An instant holds at most one
    row per district.
    """
    per_instant = rows.groupBy("observed_at").agg(F.count(F.lit(1)).alias("_n"))
    day = F.floor(F.unix_seconds("observed_at") / 86_400)
    per_day = per_instant.groupBy(day.alias("_day")).agg(F.sum("_n").alias("_day_n"))
    upto = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    day_start = per_day.select("_day", F.coalesce(F.sum("_day_n").over(upto), F.lit(0)).alias("_a"))
    within = (
        Window.partitionBy("_day")
        .orderBy("observed_at")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    touched = (
        per_instant.withColumn("_day", day)
        .withColumn("_b", F.coalesce(F.sum("_n").over(within), F.lit(0)))
        .join(day_start, "_day")
        .withColumn("_skipped", F.col("_a") + F.col("_b"))
        .where(
            (F.col("_skipped") < offset + limit) & (F.col("_skipped") + F.col("_n") > offset)
        )
        .select(
            F.unix_micros("observed_at").alias("_at"),
            "_skipped",
            local_date(F.col("observed_at")).alias("_date"),
        )
        .collect()
    )
    if not touched:
        return rows.limit(0)
    dates = [row["_date"] for row in touched]
    near = rows if between is None else between(min(dates), max(dates))
    instants = [row["_at"] for row in touched]
    near = near.where(F.unix_micros("observed_at").between(min(instants), max(instants)))
    few = rows.sparkSession.createDataFrame(
        [(row["_at"], row["_skipped"]) for row in touched], "_at bigint, _skipped bigint"
    )
    position = F.row_number().over(Window.partitionBy("observed_at").orderBy("district_id"))
    return (
        near.withColumn("_at", F.unix_micros("observed_at"))
        .join(F.broadcast(few), "_at")
        .withColumn("_position", F.col("_skipped") + position)
        .where((F.col("_position") > offset) & (F.col("_position") <= offset + limit))
        .select(*rows.columns)
        .orderBy("observed_at", "district_id")
    )


def export_window(
    table: DataFrame,
    spec: TableSpec,
    start: date | None = None,
    end: date | None = None,
    dim_hour: DataFrame | None = None,
) -> DataFrame:
    """Rows of a table inside an inclusive date window, in released column order; the partition
    column comes last where the table has one."""
    if (start is None) != (end is None):
        raise ValueError("start and end must be given together")
    columns = [*spec.columns, *[c for c in table.columns if c == PARTITION_COLUMN]]
    if start is None:
        return table.select(*columns)
    pruned = _in_months(table, start, end)
    if spec.date_via_hour:
        hours = _date_filter(dim_hour, start, end).select("hour_key")
        return pruned.join(hours, "hour_key").select(*columns)
    if spec.date_column is None:
        raise ValueError(f"{spec.name} does not support date filtering")
    return _date_filter(pruned, start, end, spec.date_column).select(*columns)


def star_view(
    fact: DataFrame, dim_hour: DataFrame, dim_date: DataFrame, dim_district: DataFrame
) -> DataFrame:
    """Hourly fact with its hour, calendar and district attributes."""
    hours = dim_hour.select("hour_key", "date_key", "observed_date", "observed_at")
    days = dim_date.drop("date")
    return fact.join(hours, "hour_key").join(days, "date_key").join(dim_district, "district_id")
