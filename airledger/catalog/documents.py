"""Landing documents assembled from observation rows.

A document covers one district and one month (daily) or one day (hourly, unless ``monthly``);
the arrays gathered into it are bounded by the calendar, not by the number of source rows. A
batch holds the districts of one range of ``size`` numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airledger.functions.temporal import local_wall_clock
from airledger.operators.payload import Kind

BATCH_DISTRICTS = 50


def _timed(rows: DataFrame, kind: Kind, monthly: bool) -> DataFrame:
    """Add the time text and the document's date range."""
    if kind.hourly:
        wall = local_wall_clock(F.col("observed_at"))
        day, time = wall.cast("date"), F.date_format(wall, "yyyy-MM-dd'T'HH:mm")
    else:
        day = F.col("observed_date")
        time = day.cast("string")
    if monthly or not kind.hourly:
        first, last = F.trunc(day, "month"), F.last_day(day)
    else:
        first = last = day
    return rows.withColumns({"time": time, "start_date": first, "end_date": last})


def _stored(rows: DataFrame, kind: Kind) -> list[str]:
    return [m for m in kind.measures if m in rows.columns]


def series_per_district(rows: DataFrame, kind: Kind, *, monthly: bool = False) -> DataFrame:
    """(district_id, start_date, end_date, series struct of arrays ordered by time)."""
    measures = _stored(rows, kind)
    timed = _timed(rows, kind, monthly)
    steps = F.sort_array(F.collect_list(F.struct("time", *measures)))
    grouped = timed.groupBy("district_id", "start_date", "end_date").agg(steps.alias("steps"))
    arrays = [F.col(f"steps.{name}").alias(name) for name in ("time", *measures)]
    return grouped.select("district_id", "start_date", "end_date", F.struct(*arrays).alias("series"))


def _body(kind: Kind, series: Column) -> Column:
    return F.struct(series.alias(kind.section))


def single_documents(rows: DataFrame, kind: Kind, feed: str) -> DataFrame:
    series = series_per_district(rows, kind)
    return landing(series, kind, feed)


def landing(series: DataFrame, kind: Kind, feed: str) -> DataFrame:
    """Landing rows with one document per series row."""
    number = F.col("district_id").cast("string")
    return series.select(
        F.concat_ws("/", F.lit(feed), number, F.col("start_date").cast("string")).alias("doc_id"),
        F.lit(feed).alias("feed"),
        F.array("district_id").alias("district_ids"),
        "start_date",
        "end_date",
        F.to_json(_body(kind, F.col("series"))).alias("body"),
    )


def batch_documents(
    rows: DataFrame,
    kind: Kind,
    feed: str,
    size: int = BATCH_DISTRICTS,
    *,
    monthly: bool = False,
) -> DataFrame:
    """One document per date range and batch with an array element for each district."""
    batch = F.floor(F.col("district_id") / size)
    series = series_per_district(rows, kind, monthly=monthly).withColumn("batch", batch)
    members = F.sort_array(F.collect_list(F.struct("district_id", "series")))
    grouped = series.groupBy("batch", "start_date", "end_date").agg(members.alias("members"))
    return grouped.select(
        F.concat_ws(
            "/", F.lit(feed), F.col("batch").cast("string"), F.col("start_date").cast("string")
        ).alias("doc_id"),
        F.lit(feed).alias("feed"),
        F.col("members.district_id").alias("district_ids"),
        "start_date",
        "end_date",
        F.to_json(
            F.transform("members", lambda m: _body(kind, m["series"]))
        ).alias("body"),
    )
