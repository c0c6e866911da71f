"""The star schema derived from generic tables (customer, orders, events).

District = customer, placed where its nation is. Daily fact = orders by customer and day.
Hourly facts = events by user (a customer number) and hour; event times are read as local
wall-clock time. Every source row counts: amounts of rows that share a key are summed. Facts
and the district dimension therefore grow with the tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.catalog.recipes import AQI_RECIPES, DAILY_RECIPES, HOURLY_RECIPES, Recipe
from airledger.functions.temporal import (
    date_key,
    instant_of_wall_clock,
    local_wall_clock,
    start_of_hour,
)
from airledger.operators.calendar import calendar_between
from airledger.operators.hours import assign_hour_keys
from airledger.schemas import DIM_HOUR
from airledger.session import Staging

# Declared, so that no job is needed to find a file's schema.
SOURCE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def source(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def _measures(recipes: list[Recipe]) -> list[Column]:
    return [F.expr(r.sql("cents")) for r in recipes]


def cents(amount: str) -> Column:
    return F.rint(F.col(amount) * 100).cast("long")


def _between(df: DataFrame, column: str, start: date | None, end: date | None) -> DataFrame:
    """Day range as a predicate on the raw time column, so that it reaches the file scan."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(F.col(column) < F.date_add(F.lit(end), 1).cast("timestamp_ntz"))
    return df


def districts(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("c_nationkey").cast("double")
    return source(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("district_id"),
        F.col("c_name").alias("district_name"),
        (F.lit(20.5) + number * 5 / F.lit(100.0)).alias("latitude"),
        (F.lit(105.2) + number * 3 / F.lit(100.0)).alias("longitude"),
    )


def daily_cents(
    spark: SparkSession, sf: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    orders = _between(source(spark, sf, "orders"), "o_orderdate", start, end)
    keyed = orders.select(
        F.col("o_custkey").cast("int").alias("district_id"),
        F.col("o_orderdate").cast("date").alias("observed_date"),
        cents("o_totalprice").alias("cents"),
    )
    return keyed.groupBy("district_id", "observed_date").agg(F.sum("cents").alias("cents"))


def daily_rows(summed: DataFrame) -> DataFrame:
    return summed.select(
        "district_id",
        date_key(F.col("observed_date")).alias("date_key"),
        "observed_date",
        *_measures(DAILY_RECIPES),
    )


def daily_fact(
    spark: SparkSession, sf: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    return daily_rows(daily_cents(spark, sf, start, end))


def daily_of_events(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rows that end with the hourly ones: event amounts summed by user and day."""
    keyed = source(spark, sf, "events").select(
        F.col("user_id").cast("int").alias("district_id"),
        F.col("ts").cast("date").alias("observed_date"),
        cents("value").alias("cents"),
    )
    summed = keyed.groupBy("district_id", "observed_date").agg(F.sum("cents").alias("cents"))
    return summed.select("district_id", "observed_date", *_measures(DAILY_RECIPES))


def _events_by_hour(events: DataFrame) -> DataFrame:
    keyed = events.select(
        F.col("user_id").cast("int").alias("district_id"),
        start_of_hour(F.col("ts")).alias("hour"),
        cents("value").alias("cents"),
    )
    summed = keyed.groupBy("district_id", "hour").agg(F.sum("cents").alias("cents"))
    return summed.withColumn("observed_at", instant_of_wall_clock(F.col("hour")))


def hourly_rows(
    spark: SparkSession,
    sf: str,
    start: date | None = None,
    end: date | None = None,
    *,
    keep_hour: bool = False,
) -> DataFrame:
    """Hourly weather keyed by instant, before a surrogate key is attached."""
    events = _between(source(spark, sf, "events"), "ts", start, end)
    return _events_by_hour(events).select(
        "district_id",
        *(["hour"] if keep_hour else []),
        "observed_at",
        *_measures(HOURLY_RECIPES),
    )


def aqi_rows(
    spark: SparkSession,
    sf: str,
    start: date | None = None,
    end: date | None = None,
    *,
    keep_hour: bool = False,
) -> DataFrame:
    events = _between(source(spark, sf, "events"), "ts", start, end)
    return _events_by_hour(events).select(
        "district_id",
        *(["hour"] if keep_hour else []),
        "observed_at",
        *_measures(AQI_RECIPES),
    )


def event_hours(spark: SparkSession, sf: str, start: date | None = None) -> DataFrame:
    """Distinct hours of the events, reading their time column only."""
    events = _between(source(spark, sf, "events"), "ts", start, None)
    hours = events.select(start_of_hour(F.col("ts")).alias("hour")).distinct()
    day = F.col("hour").cast("date")
    return hours.select(
        date_key(day).alias("date_key"),
        day.alias("observed_date"),
        instant_of_wall_clock(F.col("hour")).alias("observed_at"),
    )


def empty_hours(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DIM_HOUR.stored)


class Star:
    """The derived star schema for one query.

    As in a warehouse, the hour dimension is a stored table: it is derived once, written to
    the shared folder, and joined by its known size from then on.
    """

    def __init__(self, spark: SparkSession, sf: str) -> None:
        self.spark = spark
        self.sf = sf
        self.stage = Staging(spark, "query")
        self._hours: DataFrame | None = None

    @property
    def hours(self) -> DataFrame:
        if self._hours is None:
            derived = event_hours(self.spark, self.sf)
            self._hours = self.stage.put(
                assign_hour_keys(derived, empty_hours(self.spark)), "dim_hour"
            )
        return self._hours

    @property
    def districts(self) -> DataFrame:
        return districts(self.spark, self.sf)

    @property
    def dates(self) -> DataFrame:
        """Calendar over the days the hour dimension spans."""
        return calendar_between(
            self.hours.agg(
                F.min("observed_date").alias("start_date"),
                F.max("observed_date").alias("end_date"),
            )
        )

    def daily(self, start: date | None = None, end: date | None = None) -> DataFrame:
        return daily_fact(self.spark, self.sf, start, end)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        """Attach the surrogate key by wall-clock hour: the zone arithmetic is then done on
        the few dimension rows and not, as a pushed-down null check, on every event."""
        lookup = self.hours.select(
            local_wall_clock(F.col("observed_at")).alias("hour"), "hour_key"
        )
        return rows.join(lookup, "hour").drop("hour", "observed_at")

    def hourly(self, start: date | None = None, end: date | None = None) -> DataFrame:
        return self._keyed(hourly_rows(self.spark, self.sf, start, end, keep_hour=True))

    def aqi(self, start: date | None = None, end: date | None = None) -> DataFrame:
        return self._keyed(aqi_rows(self.spark, self.sf, start, end, keep_hour=True))


def shown(df: DataFrame) -> DataFrame:
    """Instants as local wall-clock time, which no session setting can change."""
    if "observed_at" not in df.columns:
        return df
    return df.withColumn("observed_at", local_wall_clock(F.col("observed_at")))
