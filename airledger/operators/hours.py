"""Hour dimension: surrogate keys and the joins that use them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airledger.functions.temporal import date_key, local_date, month_key


def distinct_hours(*facts: DataFrame) -> DataFrame:
    """Unique ``(date_key, observed_date, observed_at)`` over all given hourly rows."""
    instants = facts[0].select("observed_at")
    for fact in facts[1:]:
        instants = instants.unionByName(fact.select("observed_at"))
    day = local_date(F.col("observed_at"))
    return instants.distinct().select(
        date_key(day).alias("date_key"), day.alias("observed_date"), "observed_at"
    )


def assign_hour_keys(hours: DataFrame, dim_hour: DataFrame) -> DataFrame:
    """Dimension rows for hours not in ``dim_hour`` yet, keyed after its greatest key.

    Keys follow insertion order, not time: an old hour that is loaded late gets a larger
    key than newer hours, which is what lets key-based watermarks notice backfills.

    Ranking is per month plus the number of new hours in earlier months, so the only
    unpartitioned window runs over one row per month.
    """
    fresh = hours.join(dim_hour.select("observed_at"), "observed_at", "left_anti").withColumn(
        "_month", month_key(F.col("observed_date"))
    )
    before = Window.orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fresh.groupBy("_month")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_month", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    rank = F.row_number().over(Window.partitionBy("_month").orderBy("observed_at"))
    base = dim_hour.select(F.coalesce(F.max("hour_key"), F.lit(0))).scalar()
    return fresh.join(offsets, "_month").select(
        (base + F.col("_before") + rank).cast("int").alias("hour_key"),
        "date_key",
        "observed_date",
        "observed_at",
    )


def refresh_hours(dim_hour: DataFrame, hours: DataFrame) -> DataFrame:
    """Upsert hours: known instants keep their key, their date columns are refreshed."""
    seen = hours.select(
        "observed_at",
        F.col("date_key").alias("_date_key"),
        F.col("observed_date").alias("_observed_date"),
    )
    known = dim_hour.join(seen, "observed_at", "left").select(
        "hour_key",
        F.coalesce("_date_key", "date_key").alias("date_key"),
        F.coalesce("_observed_date", "observed_date").alias("observed_date"),
        "observed_at",
    )
    return known.unionByName(assign_hour_keys(hours, dim_hour))


def attach_hour_key(rows: DataFrame, dim_hour: DataFrame) -> DataFrame:
    """Look an instant up in the dimension; rows must already have their hour there."""
    return rows.join(dim_hour.select("observed_at", "hour_key"), "observed_at")


def denormalise_hours(fact: DataFrame, dim_hour: DataFrame) -> DataFrame:
    """Bring ``date_key, observed_date, observed_at`` back onto an hourly fact."""
    return fact.join(
        dim_hour.select("hour_key", "date_key", "observed_date", "observed_at"),
        "hour_key",
        "left",
    )
