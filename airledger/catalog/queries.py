"""Every operator as a query over the generic tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.catalog import adapters as A
from airledger.catalog import documents as D
from airledger.catalog.jobs import JOB_QUERIES
from airledger.functions.rules import RangeRule
from airledger.functions.temporal import instant_of_wall_clock, local_wall_clock, start_of_hour
from airledger.operators import districts as O
from airledger.operators import hours as H
from airledger.operators import monitoring as M
from airledger.operators import payload as P
from airledger.operators import quality as Q
from airledger.operators import reads as R
from airledger.operators import snapshot as N
from airledger.operators.calendar import calendar_between
from airledger.operators.integrity import foreign_key_orphans
from airledger.operators.merge import fold_delta, new_rows, replace_delta
from airledger.operators.ordering import export_ordered, with_ordinal
from airledger.operators.sync import local_marks, sync_delta, watermarks
from airledger.plans.report import workflow_report as report_of
from airledger.schemas import (
    DIM_DATE,
    DIM_HOUR,
    FACT_AQI,
    FACT_DAILY,
    FACT_HOURLY,
    TABLE_SPECS,
    TableSpec,
)
from airledger.session import Staging, fresh_folder
from airledger.sinks.release_files import file_inventory, file_mismatches, write_csv
from airledger.sinks.warehouse import Warehouse
from airledger.sources.files import read_job_reports
from airledger.sources.tables import conform, read_release_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = dict(JOB_QUERIES)

# Splits of the event and order ranges. Deltas overlap what came before them.
CURRENT_END = date(2024, 1, 20)
DELTA_START = date(2024, 1, 16)
KNOWN_FROM = date(2024, 1, 11)
DAILY_CURRENT_END = date(1999, 12, 31)
DAILY_DELTA_START = date(1999, 1, 1)
SYNC_CUTOFF = datetime(2024, 1, 20, 0, 0, tzinfo=timezone.utc)
RUNS_SINCE = datetime(2024, 1, 10, 0, 0, tzinfo=timezone.utc)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# -- reads ---------------------------------------------------------------------------------


@query
def daily_range(spark, sf):
    start, end = date(1996, 3, 1), date(1999, 6, 30)
    return R.daily_range(A.daily_fact(spark, sf, start, end), None, start, end)


@query
def daily_range_district(spark, sf):
    start = date(1997, 1, 1)
    return R.daily_range(A.daily_fact(spark, sf, start), 7, start)


@query
def daily_statistics(spark, sf):
    return _rounded(
        R.daily_statistics(A.daily_fact(spark, sf)),
        "avg_temperature_2m_mean",
        "total_precipitation_sum",
    )


@query
def daily_statistics_filtered(spark, sf):
    start, end = date(1996, 1, 1), date(1998, 12, 31)
    return _rounded(
        R.daily_statistics(A.daily_fact(spark, sf, start, end), 3, start, end),
        "avg_temperature_2m_mean",
        "total_precipitation_sum",
    )


@query
def daily_statistics_no_match(spark, sf):
    return R.daily_statistics(A.daily_fact(spark, sf), -1)


@query
def hourly_page(spark, sf):
    start, end = date(2024, 1, 5), date(2024, 1, 25)
    star = A.Star(spark, sf)
    page = R.hourly_range(star.hourly(start, end), star.hours, None, start, end, 200, 50)
    return A.shown(page)


@query
def hourly_page_district(spark, sf):
    star = A.Star(spark, sf)
    return A.shown(R.hourly_range(star.hourly(), star.hours, district_id=4))


@query
def aqi_page(spark, sf):
    start = date(2024, 1, 8)
    star = A.Star(spark, sf)
    return A.shown(R.hourly_range(star.aqi(start), star.hours, None, start, None, 1000, 10))


@query
def hourly_deep_page(spark, sf):
    star = A.Star(spark, sf)
    rows = R.with_hours(star.hourly(), star.hours)
    return A.shown(
        R.deep_page(
            rows, 300, 9_000, lambda lo, hi: R.with_hours(star.hourly(lo, hi), star.hours)
        )
    )


@query
def export_window(spark, sf):
    start, end = date(2024, 1, 10), date(2024, 1, 12)
    star = A.Star(spark, sf)
    return R.export_window(star.hourly(start, end), FACT_HOURLY, start, end, star.hours)


@query
def export_window_daily(spark, sf):
    start, end = date(1998, 1, 1), date(1998, 12, 31)
    return R.export_window(A.daily_fact(spark, sf, start, end), FACT_DAILY, start, end)


@query
def star_view(spark, sf):
    star = A.Star(spark, sf)
    return A.shown(R.star_view(star.hourly(), star.hours, star.dates, star.districts))


@query
def denormalised_hours(spark, sf):
    star = A.Star(spark, sf)
    return A.shown(H.denormalise_hours(star.aqi(), star.hours))


# -- districts -----------------------------------------------------------------------------


@query
def district_lookup(spark, sf):
    return O.district_by_id(A.districts(spark, sf), 7)


@query
def district_lookup_by_name(spark, sf):
    return O.district_by_name(A.districts(spark, sf), "Customer#000000003")


@query
def district_subset(spark, sf):
    requested = A.source(spark, sf, "supplier").select(F.col("s_suppkey").alias("district_id"))
    return O.requested_districts(A.districts(spark, sf), requested, 10)


@query
def district_unknown(spark, sf):
    requested = A.source(spark, sf, "orders").select(
        (F.col("o_custkey") * 2).cast("int").alias("district_id")
    )
    return O.unknown_districts(requested, A.districts(spark, sf))


@query
def skip_loaded(spark, sf):
    fact = A.source(spark, sf, "events").select(F.col("user_id").cast("int").alias("district_id"))
    return O.not_yet_loaded(A.districts(spark, sf), fact)


# -- calendar and hours --------------------------------------------------------------------


@query
def dim_date_build(spark, sf):
    day = F.col("o_orderdate").cast("date")
    bounds = A.source(spark, sf, "orders").agg(
        F.min(day).alias("start_date"), F.max(day).alias("end_date")
    )
    return calendar_between(bounds)


@query
def hour_dim_build(spark, sf):
    return A.shown(A.event_hours(spark, sf))


@query
def hour_key_assign(spark, sf):
    """The later hours are known already; the earlier ones arrive late, with larger keys."""
    stage = Staging(spark, "query")
    hours = stage.put(A.event_hours(spark, sf), "hours")
    known = hours.where(F.col("observed_date") >= F.lit(KNOWN_FROM))
    stored = stage.put(H.assign_hour_keys(known, A.empty_hours(spark)), "dim_hour")
    return A.shown(H.refresh_hours(stored, hours))


@query
def hour_key_lookup(spark, sf):
    """From instants to surrogate keys, as rows are loaded."""
    star = A.Star(spark, sf)
    rows = A.hourly_rows(spark, sf).select("district_id", "observed_at")
    return H.attach_hour_key(star.stage.put(rows, "rows"), star.hours).drop("observed_at")


# -- payloads ------------------------------------------------------------------------------


def _payload(rows: DataFrame, kind: P.Kind, documents: DataFrame) -> DataFrame:
    parsed = P.parse_payloads(documents, kind)
    stored = [m for m in kind.measures if m in rows.columns]
    time = "observed_at" if kind.hourly else "observed_date"
    return A.shown(parsed.select("district_id", "date_key", time, *stored))


@query
def payload_daily(spark, sf):
    rows = A.daily_fact(spark, sf)
    return _payload(rows, P.DAILY, D.single_documents(rows, P.DAILY, "archive-daily"))


@query
def payload_hourly(spark, sf):
    rows = A.hourly_rows(spark, sf)
    return _payload(rows, P.HOURLY, D.single_documents(rows, P.HOURLY, "archive-hourly"))


@query
def payload_aqi(spark, sf):
    rows = A.aqi_rows(spark, sf)
    return _payload(rows, P.AQI, D.single_documents(rows, P.AQI, "archive-aqi-hourly"))


@query
def payload_batch(spark, sf):
    rows = A.hourly_rows(spark, sf)
    return _payload(rows, P.HOURLY, D.batch_documents(rows, P.HOURLY, "archive-hourly"))


@query
def payload_ragged(spark, sf):
    """One series loses its last element, one gains two, one is missing altogether."""
    rows = A.hourly_rows(spark, sf)
    series = D.series_per_district(rows, P.HOURLY)
    cut = F.slice("series.temperature_2m", F.lit(1), F.size("series.time") - 1)
    longer = F.concat("series.rain", F.array(F.lit(1.5), F.lit(2.5)))
    ragged = series.withColumn(
        "series",
        F.col("series")
        .withField("temperature_2m", cut)
        .withField("rain", longer)
        .dropFields("cloud_cover"),
    )
    return _payload(rows, P.HOURLY, D.landing(ragged, P.HOURLY, "archive-hourly"))


def _damaged_documents(spark, sf) -> DataFrame:
    """Daily documents of which some are cut short and some claim a second district."""
    documents = D.single_documents(A.daily_fact(spark, sf), P.DAILY, "archive-daily")
    number = F.col("district_ids")[0]
    broken = F.when(
        number % 5 == 1, F.substring("body", F.lit(1), F.length("body") - 3)
    ).otherwise(F.col("body"))
    claimed = F.when(number % 5 == 2, F.array(number, number + 100)).otherwise(
        F.col("district_ids")
    )
    return documents.withColumns({"body": broken, "district_ids": claimed})


@query
def payload_problems(spark, sf):
    return P.document_problems(_damaged_documents(spark, sf), P.DAILY)


@query
def missing_payload(spark, sf):
    delivered = P.parse_payloads(_damaged_documents(spark, sf), P.DAILY)
    return O.missing_payloads(A.districts(spark, sf), delivered)


# -- validation ----------------------------------------------------------------------------


def _placed(rows: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    places = A.districts(spark, sf).select("district_id", "latitude", "longitude")
    return rows.join(places, "district_id")


@query
def validate_range(spark, sf):
    """Null passes and NaN fails, whatever the bounds."""
    value = (
        F.when(F.col("event_id") % 11 == 0, F.lit(None))
        .when(F.col("event_id") % 13 == 0, F.lit(float("nan")))
        .otherwise(F.col("value"))
    )
    rule = RangeRule("reading", "5", "120.5")
    rows = A.source(spark, sf, "events").select("event_id", value.cast("double").alias("reading"))
    return rows.select("event_id", rule.violated().alias("violated"))


@query
def validate_daily(spark, sf):
    rows = _placed(A.daily_fact(spark, sf), spark, sf)
    return Q.error_rows(rows, P.DAILY.rules, "analyst.fact_weather_daily", ["date_key"])


@query
def validate_hourly(spark, sf):
    rows = _placed(A.hourly_rows(spark, sf), spark, sf)
    return A.shown(
        Q.error_rows(rows, P.HOURLY.rules, "analyst.fact_weather_hourly", ["observed_at"])
    )


@query
def validate_aqi(spark, sf):
    rows = _placed(A.aqi_rows(spark, sf), spark, sf)
    return A.shown(Q.error_rows(rows, P.AQI.rules, "analyst.fact_aqi_hourly", ["observed_at"]))


@query
def validate_valid(spark, sf):
    rows = _placed(A.hourly_rows(spark, sf), spark, sf)
    return A.shown(Q.valid_rows(rows, P.HOURLY.rules))


@query
def validate_rejected(spark, sf):
    rows = _placed(A.daily_fact(spark, sf), spark, sf)
    return Q.rejected_rows(rows, P.DAILY.rules).select("district_id", "date_key")


@query
def validate_counts(spark, sf):
    def counted(rows, kind):
        outcome = Q.count_outcomes(_placed(rows, spark, sf), kind.rules)
        return outcome.withColumn("kind", F.lit(kind.name))

    return (
        counted(A.daily_fact(spark, sf), P.DAILY)
        .unionByName(counted(A.hourly_rows(spark, sf), P.HOURLY))
        .unionByName(counted(A.aqi_rows(spark, sf), P.AQI))
    )


@query
def dup_keys(spark, sf):
    keyed = A.source(spark, sf, "events").select(
        F.col("user_id").cast("int").alias("district_id"),
        start_of_hour(F.col("ts")).alias("observed_at"),
    )
    return Q.duplicate_keys(keyed, ["district_id", "observed_at"])


@query
def orphan_check(spark, sf):
    child = A.source(spark, sf, "orders").select(
        (F.col("o_custkey") * 3).cast("int").alias("district_id")
    )
    return Q.orphans(child, "district_id", A.districts(spark, sf), "district_id")


@query
def coordinate_check(spark, sf):
    return Q.coordinate_errors(A.districts(spark, sf))


# -- load and merge ------------------------------------------------------------------------


def _as_doubles(df: DataFrame) -> DataFrame:
    """Reals shown as doubles, shorts as integers; values do not change."""
    wide = {"float": "double", "smallint": "int"}
    return df.select(
        *[F.col(c).cast(wide[t]).alias(c) if t in wide else F.col(c) for c, t in df.dtypes]
    )


@query
def load_projection(spark, sf):
    rows = _placed(A.daily_fact(spark, sf), spark, sf)
    return _as_doubles(N.load_projection(rows, FACT_DAILY))


@query
def release_widen(spark, sf):
    stored = N.load_projection(A.Star(spark, sf).hourly(), FACT_HOURLY)
    return N.release_form(stored, FACT_HOURLY)


@query
def insert_ignore(spark, sf):
    """Half of the calendar is there already, with marks that must survive."""
    day = F.col("o_orderdate").cast("date")
    orders = A.source(spark, sf, "orders")
    first_half = orders.agg(
        F.min(day).alias("start_date"), F.lit(DAILY_CURRENT_END).alias("end_date")
    )
    existing = calendar_between(first_half).withColumn("quarter", F.lit(0))
    whole = calendar_between(
        orders.agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"))
    )
    return existing.unionByName(new_rows(existing, whole, DIM_DATE.primary_key))


def _shifted(rows: DataFrame, measures: list[str]) -> DataFrame:
    """Delta values differ from current ones, so that a replaced row can be told apart."""
    return rows.withColumns({m: F.col(m) + 1 for m in measures if m != "weather_code"})


def _upsert(stage: Staging, current: DataFrame, delta: DataFrame, spec: TableSpec) -> DataFrame:
    """A delta is stored before it is merged, because the merge reads it twice."""
    incoming = stage.put(N.load_projection(delta, spec), "delta")
    return _as_doubles(replace_delta(N.load_projection(current, spec), incoming, spec))


@query
def upsert_daily(spark, sf):
    current = A.daily_fact(spark, sf, None, DAILY_CURRENT_END)
    delta = _shifted(
        A.daily_fact(spark, sf, DAILY_DELTA_START), [r.measure for r in A.DAILY_RECIPES]
    )
    return _upsert(Staging(spark, "query"), current, delta, FACT_DAILY)


@query
def upsert_hourly(spark, sf):
    star = A.Star(spark, sf)
    current = star.hourly(None, CURRENT_END)
    delta = _shifted(star.hourly(DELTA_START), [r.measure for r in A.HOURLY_RECIPES])
    return _upsert(star.stage, current, delta, FACT_HOURLY)


@query
def upsert_aqi(spark, sf):
    star = A.Star(spark, sf)
    current = star.aqi(None, CURRENT_END)
    delta = _shifted(star.aqi(DELTA_START), [r.measure for r in A.AQI_RECIPES])
    return _upsert(star.stage, current, delta, FACT_AQI)


@query
def upsert_keep_absent(spark, sf):
    """A delta without some columns leaves their current values alone."""
    stage = Staging(spark, "query")
    current = A.daily_fact(spark, sf, None, DAILY_CURRENT_END)
    stored = stage.put(N.load_projection(current, FACT_DAILY), "current")
    delta = A.daily_fact(spark, sf, DAILY_DELTA_START).drop("rain_sum", "precipitation_sum")
    incoming = stage.put(delta, "delta")
    return _as_doubles(replace_delta(stored, incoming, FACT_DAILY, keep_absent=True))


@query
def merge_snapshot(spark, sf):
    star = A.Star(spark, sf)
    current = star.hourly(None, CURRENT_END)
    delta = _shifted(star.hourly(DELTA_START), [r.measure for r in A.HOURLY_RECIPES])
    return N.merge_snapshot(current, delta, FACT_HOURLY)


@query
def merge_snapshot_first(spark, sf):
    return N.merge_snapshot(None, A.daily_fact(spark, sf), FACT_DAILY)


@query
def snapshot_schema_fill(spark, sf):
    """The current snapshot predates one measure; the delta has it."""
    star = A.Star(spark, sf)
    current = star.hourly(None, CURRENT_END).drop("wind_direction_10m")
    delta = star.hourly(DELTA_START)
    return N.merge_snapshot(conform(current, FACT_HOURLY.released), delta, FACT_HOURLY)


# -- sync ----------------------------------------------------------------------------------


@query
def watermarks_by_district(spark, sf):
    return watermarks(A.Star(spark, sf).hourly(), FACT_HOURLY)


@query
def watermark_dimension(spark, sf):
    return watermarks(A.Star(spark, sf).hours, DIM_HOUR)


def _local(districts: DataFrame) -> DataFrame:
    """The target knows all districts but those far north (nations from 20 on)."""
    return districts.where(F.col("latitude") < 21.48)


def _copied(star: A.Star, source: DataFrame) -> DataFrame:
    """The target has copied early hours, and of some districts it knows nothing at all."""
    early = star.hours.where(F.col("observed_date") <= F.lit(DELTA_START)).select("hour_key")
    places = _local(star.districts).where(F.col("latitude") > 20.62).select("district_id")
    return source.join(early, "hour_key", "left_semi").join(places, "district_id", "left_semi")


def _hourly_delta(star: A.Star, source: DataFrame, target: DataFrame) -> DataFrame:
    marks = local_marks(_local(star.districts), watermarks(target, FACT_HOURLY))
    return sync_delta(
        source, FACT_HOURLY, star.stage.put(marks, "marks"), SYNC_CUTOFF, dim_hour=star.hours
    )


@query
def sync_delta_facts(spark, sf):
    star = A.Star(spark, sf)
    source = star.stage.put(star.hourly(), "source")
    return _hourly_delta(star, source, _copied(star, source))


@query
def sync_delta_daily(spark, sf):
    star = A.Star(spark, sf)
    copied = watermarks(star.daily(None, DAILY_CURRENT_END), FACT_DAILY)
    marks = star.stage.put(local_marks(_local(star.districts), copied), "marks")
    return sync_delta(
        star.daily(), FACT_DAILY, marks, datetime(2000, 6, 1, tzinfo=timezone.utc)
    )


@query
def sync_delta_dim(spark, sf):
    hours = A.Star(spark, sf).hours
    copied = hours.where(F.col("observed_date") <= F.lit(DELTA_START))
    delta = sync_delta(
        hours, DIM_HOUR, watermarks(copied, DIM_HOUR), datetime(2024, 1, 12, tzinfo=timezone.utc)
    )
    return A.shown(delta)


@query
def sync_apply(spark, sf):
    """Source and target are stored, so the events are read once."""
    star = A.Star(spark, sf)
    source = star.stage.put(star.hourly(), "source")
    target = _copied(star, source)
    older = _shifted(target, [r.measure for r in A.HOURLY_RECIPES])
    return fold_delta(
        conform(older, FACT_HOURLY.released), _hourly_delta(star, source, target), FACT_HOURLY,
        schema=FACT_HOURLY.released, keep_absent=True,
    )


# -- order ---------------------------------------------------------------------------------


@query
def export_order(spark, sf):
    """The place of each daily row in its export."""
    stage = Staging(spark, "query")
    return export_ordered(stage, A.daily_fact(spark, sf), FACT_DAILY).select(
        "district_id", "date_key", "ordinal"
    )


@query
def read_order(spark, sf):
    """The place of each row in a daily read, which goes by date before district."""
    rows = R.daily_range(A.daily_fact(spark, sf), start=date(1996, 3, 1), end=date(1999, 6, 30))
    ordered = with_ordinal(Staging(spark, "query"), rows, R.DAILY_ORDER, "rows")
    return ordered.select("district_id", "observed_date", "ordinal")


# -- foreign keys --------------------------------------------------------------------------


@query
def foreign_keys(spark, sf):
    """All seven foreign keys of a warehouse whose dimensions lack rows: every tenth district,
    the 13th of each month, and all hours from five to six."""
    star = A.Star(spark, sf)
    hours = star.hours
    days = A.daily_fact(spark, sf).select("observed_date").unionByName(
        hours.select("observed_date")
    )
    dates = days.distinct().select(
        F.date_format("observed_date", "yyyyMMdd").cast("int").alias("date_key")
    )
    wall = local_wall_clock(F.col("observed_at"))
    return foreign_key_orphans(
        {
            "dim_district": star.districts.where(F.col("district_id") % 10 != 3),
            "dim_date": dates.where(F.col("date_key") % 100 != 13),
            "dim_hour": hours.where(F.hour(wall) != 5),
            "fact_weather_daily": star.daily(),
            "fact_weather_hourly": star.hourly(),
            "fact_aqi_hourly": star.aqi().where(F.col("district_id") % 2 == 1),
        }
    )


# -- releases ------------------------------------------------------------------------------


def _stats(spark, sf) -> DataFrame:
    """Statistics of the six tables as a release would measure them."""
    star = A.Star(spark, sf)
    tables = {
        "dim_district": star.districts,
        "dim_date": star.dates,
        "dim_hour": star.hours,
        "fact_weather_daily": star.daily(),
        "fact_weather_hourly": star.hourly(),
        "fact_aqi_hourly": star.aqi(),
    }
    stats = [N.table_stats(tables[spec.name], spec) for spec in TABLE_SPECS]
    whole = stats[0]
    for part in stats[1:]:
        whole = whole.unionByName(part)
    return whole


def _measured(spark, sf) -> DataFrame:
    """The statistics measured once, as a release does before it is judged."""
    return N.hour_range_from_dimension(Staging(spark, "query").put(_stats(spark, sf), "stats"))


@query
def table_stats(spark, sf):
    return _stats(spark, sf)


@query
def release_hour_range(spark, sf):
    return _measured(spark, sf)


@query
def release_gate(spark, sf):
    """Orders and events end on different days, so the gate has something to report."""
    return N.release_problems(_measured(spark, sf), date(2024, 1, 31))


@query
def release_gate_incomplete(spark, sf):
    facts = _measured(spark, sf).where(F.col("name") != "dim_date")
    hour_end = facts.where(F.col("name") == "dim_hour").select(F.max("max_date")).scalar()
    level = facts.withColumn("max_date", F.when(F.col("max_date").isNotNull(), hour_end))
    return N.release_problems(level, date(2030, 1, 1))


def _release_listing(spark, sf) -> DataFrame:
    """One file per order and release day, some below malformed folders."""
    stamp = F.date_format("o_orderdate", "yyyyMMdd")
    odd = F.col("o_orderkey") % 10 == 0
    folder = F.when(odd, stamp).otherwise(F.concat(stamp, F.lit("T040000Z")))
    return A.source(spark, sf, "orders").select(
        F.concat(
            F.lit("v1/releases/"), folder, F.lit("/analyst/part-"),
            F.col("o_orderkey").cast("string"),
        ).alias("path")
    )


@query
def release_retention(spark, sf):
    return N.deletable_files(_release_listing(spark, sf), "19990101T040000Z")


@query
def csv_roundtrip(spark, sf):
    stored = N.load_projection(A.daily_fact(spark, sf), FACT_DAILY)
    folder = fresh_folder(spark, "csv")
    write_csv(N.release_form(stored, FACT_DAILY), FACT_DAILY, folder)
    return read_release_csv(spark, folder, FACT_DAILY)


def _files_per_block(customers: DataFrame, folder: str) -> str:
    """Customers as text, one file for each block of a hundred numbers."""
    block = F.floor(F.col("c_custkey") / 100).cast("string")
    (
        customers.select(
            F.concat(F.lit("block-"), block, F.lit(".csv")).alias("table"),
            "c_custkey",
            F.concat_ws(",", "c_custkey", "c_name", "c_mktsegment").alias("line"),
        )
        .repartition("table")
        .sortWithinPartitions("table", "c_custkey")
        .drop("c_custkey")
        .write.partitionBy("table")
        .text(folder)
    )
    return folder


def _block_inventory(spark, customers: DataFrame) -> DataFrame:
    folder = _files_per_block(customers, fresh_folder(spark, "files"))
    return file_inventory(spark, folder)


@query
def release_inventory(spark, sf):
    """Length and SHA-256 of table files, hashed where they lie."""
    found = _block_inventory(spark, A.source(spark, sf, "customer"))
    return found.select("name", "format", "length", "sha256")


@query
def release_verify_tampered(spark, sf):
    """Files found against files recorded: some are altered, some gone, some strange."""
    customers = A.source(spark, sf, "customer")
    block = F.floor(F.col("c_custkey") / 100)
    name = F.when(
        (block % 5 == 1) & (F.col("c_custkey") % 100 == 7), F.concat("c_name", F.lit("!"))
    ).otherwise(F.col("c_name"))
    tampered = customers.withColumn("c_name", name).where(block % 5 != 2)
    added = customers.where(block % 5 == 3).withColumn("c_custkey", F.col("c_custkey") + 1_000_000_000)
    one = F.lit("part").alias("file")
    sides = [
        _block_inventory(spark, side).withColumn("file", one)
        for side in (customers, tampered.unionByName(added))
    ]
    return file_mismatches(*sides).drop("file")


# -- monitoring ----------------------------------------------------------------------------


def _run_records(spark, sf) -> DataFrame:
    """Two appended records per event: the run as opened and, for most, as closed."""
    opened = instant_of_wall_clock(F.col("ts"), "UTC")
    kind = F.element_at(
        F.array(*[F.lit(t) for t in M.SCHEDULED_RUN_TYPES]),
        (F.col("user_id") % 3 + 1).cast("int"),
    )
    finished = F.timestamp_micros(
        F.unix_micros("started_at") + F.floor(F.col("value") * 1_000_000).cast("long")
    )
    loaded = F.when(F.col("value") < 2, F.lit(0)).otherwise(F.floor("value")).cast("long")
    failed = F.col("event_type") == "error"

    def record(status, finished_at, inserted, skipped):
        return F.struct(
            status.alias("status"),
            finished_at.alias("finished_at"),
            inserted.alias("rows_inserted"),
            skipped.alias("rows_skipped"),
        )

    none = F.lit(0).cast("long")
    running = record(F.lit("running"), F.lit(None).cast("timestamp"), none, none)
    status = F.when(failed, F.lit("failed")).otherwise(F.lit("completed"))
    closed = record(status, finished, loaded, F.col("etl_run_id") % 7)
    records = F.when(F.col("event_type") == "signup", F.array(running)).otherwise(
        F.array(running, closed)
    )
    events = A.source(spark, sf, "events").select(
        F.col("event_id").alias("etl_run_id"),
        kind.alias("run_type"),
        opened.alias("started_at"),
        "event_type",
        "value",
    )
    return events.select("etl_run_id", "run_type", "started_at", F.inline(records))


def _runs(spark, sf, since=None) -> DataFrame:
    return M.latest_run_state(_run_records(spark, sf), since)


@query
def run_latest(spark, sf):
    return _runs(spark, sf).select("etl_run_id", "run_type", "status", "rows_inserted")


@query
def run_report(spark, sf):
    return M.run_report(_runs(spark, sf, F.lit(RUNS_SINCE)), F.lit(RUNS_SINCE))


@query
def run_totals(spark, sf):
    totals = M.run_totals(_runs(spark, sf, F.lit(RUNS_SINCE)), F.lit(RUNS_SINCE))
    return totals.withColumn("first_start", F.convert_timezone(None, F.lit("UTC"), "first_start"))


@query
def run_catchup(spark, sf):
    return M.catchup_needed(
        _runs(spark, sf, F.lit(RUNS_SINCE)), F.lit(RUNS_SINCE), scheduled=True, job_succeeded=True
    )


@query
def run_types(spark, sf):
    return M.runs_by_type(_runs(spark, sf, F.lit(RUNS_SINCE)), F.lit(RUNS_SINCE))


@query
def run_catchup_flags(spark, sf):
    """The catch-up rule under every combination of flags: windows with all runs, with completed
    runs alone, and without any."""
    runs = Staging(spark, "query").put(_runs(spark, sf), "runs")
    windows = {
        "all": (runs, RUNS_SINCE),
        "completed": (runs.where("status = 'completed'"), RUNS_SINCE),
        "none": (runs, datetime(2090, 1, 1, tzinfo=timezone.utc)),
    }
    found = [
        M.catchup_needed(
            window, F.lit(since), scheduled=scheduled, job_succeeded=succeeded, error=error
        ).select(
            F.lit(label).alias("window"),
            F.lit(scheduled).alias("scheduled"),
            F.lit(succeeded).alias("job_succeeded"),
            F.lit(error).alias("error"),
            "*",
        )
        for label, (window, since) in windows.items()
        for scheduled, succeeded, error in product((True, False), repeat=3)
    ]
    return reduce(DataFrame.unionAll, found)


def _job_report_files(spark, sf) -> str:
    """One JSON document per day and event type, spread over nested folders, beside documents
    that aren't job reports."""
    folder = fresh_folder(spark, "reports")
    day = F.col("ts").cast("date")
    zulu = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    jobs = (
        A.source(spark, sf, "events")
        .where(F.col("ts") >= F.lit("2024-01-12").cast("timestamp_ntz"))
        .groupBy(day.alias("day"), F.col("event_type").alias("kind"))
        .agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("events"))
        .withColumn("job", F.concat_ws("/", F.col("day").cast("string"), "kind"))
    )
    document = [
        F.when(F.col("kind") != "view", F.col("job")).alias("job_id"),
        F.when(F.col("events") % 2 == 0, "success").otherwise("failure").alias("status"),
        F.concat(F.date_format("first", zulu), F.lit("+00:00")).alias("started_at_utc"),
        F.concat(F.date_format("last", zulu), F.lit("+00:00")).alias("finished_at_utc"),
        F.col("events").alias("duration_seconds"),
    ]
    jobs.select("day", "kind", *document).repartition("day", "kind").write.partitionBy(
        "day", "kind"
    ).option("pretty", "true").json(folder)
    return folder


@query
def job_reports(spark, sf):
    """Every job report below a folder."""
    found = read_job_reports(spark, _job_report_files(spark, sf))
    return found.select("job_id", "status", "started_at_utc", "finished_at_utc", "duration_seconds")


@query
def workflow_report(spark, sf):
    """The runs since the oldest reported job start, from a warehouse's own records."""
    return _workflow(spark, sf).runs


@query
def workflow_totals(spark, sf):
    """Totals of those runs by type, and whether the window has to be caught up."""
    report = _workflow(spark, sf)
    return report.types.withColumns(
        {
            "needed": report.catchup.select("needed").scalar(),
            "catchup_date": report.catchup.select("catchup_date").scalar(),
        }
    )


def _workflow(spark, sf):
    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"))
    none = F.lit(None).cast("string").alias("error_summary")
    records = _run_records(spark, sf).withColumn("rows_updated", F.lit(0).cast("long"))
    warehouse.append("etl_runs", records.select("*", none))
    return report_of(
        warehouse,
        datetime(2024, 1, 1, tzinfo=timezone.utc),
        job_reports=_job_report_files(spark, sf),
    )


@query
def job_duration(spark, sf):
    timed = _run_records(spark, sf).select(
        F.col("etl_run_id").alias("job_id"), "status", "started_at", "finished_at"
    )
    return M.job_durations(timed.where(F.col("finished_at").isNotNull()))


@query
def warehouse_snapshot(spark, sf):
    star = A.Star(spark, sf)
    return M.warehouse_snapshot(star.daily(), star.hourly(), star.aqi(), star.hours)
