"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.functions.temporal import calendar_attributes

CALENDAR_START = date(2023, 6, 1)


def calendar_between(bounds: DataFrame) -> DataFrame:
    """Calendar rows for every day of a one-row frame ``(start_date, end_date)``, inclusive.

    A start after the end gives no rows (``sequence`` alone would count backwards).
    """
    days = bounds.where(F.col("start_date") <= F.col("end_date")).select(
        F.explode(F.sequence("start_date", "end_date")).alias("day")
    )
    return days.select(*calendar_attributes(F.col("day")))


def build_dim_date(
    spark: SparkSession, start: date = CALENDAR_START, end: date | None = None
) -> DataFrame:
    last = F.current_date() if end is None else F.lit(end)
    bounds = spark.range(1).select(
        F.lit(start).alias("start_date"), last.alias("end_date")
    )
    return calendar_between(bounds)
