"""Whole jobs as queries: documents made from the tables are landed, loaded and read back.

Each query fills a warehouse of its own below the shared folder. Districts outside the
permitted area are not seeded, so their documents do not load.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.catalog import adapters as A
from airledger.catalog import documents as D
from airledger.functions.rules import COORDINATE_RULES
from airledger.functions.temporal import local_wall_clock
from airledger.operators import payload as P
from airledger.operators.quality import valid_rows
from airledger.operators.reads import with_hours
from airledger.operators.snapshot import release_summary as summarised
from airledger.plans.catchup import backfill_hourly, catch_up
from airledger.plans.etl import ensure_dates, load_history, run_etl, seed_districts
from airledger.plans.release import bootstrap, publish
from airledger.plans.sync import sync_summary as summary_of
from airledger.plans.sync import sync_warehouses
from airledger.schemas import DIM_DISTRICT, DIM_HOUR, FACT_AQI, FACT_DAILY, FACT_HOURLY
from airledger.session import Staging, fresh_folder
from airledger.sinks.release_files import CURRENT, ReleaseStore
from airledger.sinks.warehouse import Warehouse
from airledger.sources.files import read_manifest
from airledger.sources.landing import read_landing_files, read_landing_table
from airledger.sources.tables import read_districts_csv, read_release_csv

JOB_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# Folder names list the districts of a batch, so a landed batch is kept short.
LANDED_BATCH = 20
SPLIT = date(1999, 12, 31)
BACKFILL_START = date(2024, 1, 11)
FIRST_RELEASE_END = date(2024, 1, 20)

_ROWS = {"daily": A.daily_fact, "hourly": A.hourly_rows, "aqi-hourly": A.aqi_rows}


def job_query(function):
    JOB_QUERIES[function.__name__] = function
    return function


def _new_warehouse(spark: SparkSession, sf: str, start: date, end: date) -> Warehouse:
    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"))
    seed_districts(warehouse, valid_rows(A.districts(spark, sf), COORDINATE_RULES))
    ensure_dates(warehouse, start, end)
    return warehouse


def _range(spark: SparkSession, sf: str, kind: P.Kind) -> tuple[date, date]:
    table, column = ("events", "ts") if kind.hourly else ("orders", "o_orderdate")
    day = F.col(column).cast("date")
    return tuple(A.source(spark, sf, table).agg(F.min(day), F.max(day)).first())


def land_as_table(documents: DataFrame) -> DataFrame:
    path = f"{fresh_folder(documents.sparkSession, 'landing')}/documents"
    documents.write.parquet(path)
    return read_landing_table(documents.sparkSession, path)


def land_as_files(documents: DataFrame) -> DataFrame:
    """One file per document, with its feed, range and districts in the folder names."""
    folder = fresh_folder(documents.sparkSession, "landing")
    documents.select(
        "feed",
        "start_date",
        "end_date",
        F.array_join(F.col("district_ids").cast("array<string>"), "-").alias("district_ids"),
        F.col("body").alias("value"),
    ).write.partitionBy("feed", "start_date", "end_date", "district_ids").text(folder)
    return read_landing_files(documents.sparkSession, folder)


def _loaded(spark: SparkSession, sf: str, kind: P.Kind) -> Warehouse:
    """A warehouse after the historical run of one kind.

    Air quality is landed as files, a month of a few districts each; the others as a table.
    """
    feed = f"archive-{kind.name}"
    rows = _ROWS[kind.name](spark, sf)
    if kind is P.AQI:
        landing = land_as_files(D.batch_documents(rows, kind, feed, LANDED_BATCH, monthly=True))
    elif kind.hourly:
        landing = land_as_table(D.batch_documents(rows, kind, feed))
    else:
        landing = land_as_table(D.single_documents(rows, kind, feed))
    start, end = _range(spark, sf, kind)
    warehouse = _new_warehouse(spark, sf, start, end)
    run_etl(warehouse, landing, f"historical-{kind.name}", start=start, end=end)
    return warehouse


def _plain(df: DataFrame) -> DataFrame:
    """Stored reals and shorts as doubles and integers, instants as local time."""
    wide = {"float": "double", "smallint": "int"}
    df = df.select(
        *[F.col(c).cast(wide[t]).alias(c) if t in wide else F.col(c) for c, t in df.dtypes]
    )
    if "observed_at" in df.columns:
        df = df.withColumn("observed_at", local_wall_clock(F.col("observed_at")))
    return df


def _fact(warehouse: Warehouse, kind: P.Kind, measures: list[str]) -> DataFrame:
    if not kind.hourly:
        return _plain(warehouse.table(kind.spec).select(
            "district_id", "date_key", "observed_date", *measures
        ))
    rows = with_hours(warehouse.physical(kind.spec), warehouse.table(DIM_HOUR))
    return _plain(rows.select("district_id", "observed_at", *measures))


@job_query
def etl_daily(spark, sf):
    return _fact(_loaded(spark, sf, P.DAILY), P.DAILY, [r.measure for r in A.DAILY_RECIPES])


@job_query
def etl_hourly(spark, sf):
    return _fact(_loaded(spark, sf, P.HOURLY), P.HOURLY, [r.measure for r in A.HOURLY_RECIPES])


@job_query
def etl_aqi(spark, sf):
    return _fact(_loaded(spark, sf, P.AQI), P.AQI, [r.measure for r in A.AQI_RECIPES])


@job_query
def etl_errors(spark, sf):
    """Rejected values a daily run has put down."""
    errors = _loaded(spark, sf, P.DAILY).monitoring("validation_errors")
    return errors.select(
        "etl_run_id", "source_table", "district_id", "field_name", "invalid_value", "reason",
        "severity",
    )


@job_query
def etl_counts(spark, sf):
    """The closing record of an hourly run; districts without a document count as skipped."""
    runs = _loaded(spark, sf, P.HOURLY).monitoring("etl_runs")
    return runs.where(F.col("finished_at").isNotNull()).select(
        "etl_run_id", "run_type", "status", "rows_inserted", "rows_skipped"
    )


@job_query
def etl_failures(spark, sf):
    """Districts that an hourly run found no document for, from its log."""
    logs = _loaded(spark, sf, P.HOURLY).monitoring("etl_logs")
    return logs.where(F.col("event_name") == "extract_failed").select(
        F.col("context")["district_id"].cast("int").alias("district_id"),
        F.col("context")["error"].alias("error"),
        "message",
    )


@job_query
def sync_two_warehouses(spark, sf):
    """Copy after a first run, load the rest, copy what is new, read the copy."""
    start, end = _range(spark, sf, P.DAILY)
    documents = D.single_documents(A.daily_fact(spark, sf), P.DAILY, "archive-daily")
    landing = Staging(spark, "landing").put(documents, "documents")
    source = _new_warehouse(spark, sf, start, end)
    target = Warehouse(spark, fresh_folder(spark, "warehouse"))
    later = datetime.combine(end, datetime.min.time(), timezone.utc) + timedelta(days=30)
    for first, last in ((start, SPLIT), (SPLIT + timedelta(days=1), end)):
        run_etl(source, landing, "historical-daily", start=first, end=last)
        sync_warehouses(source, target, now=later)
    return _plain(target.table(FACT_DAILY).select(
        "district_id", "date_key", "observed_date", *[r.measure for r in A.DAILY_RECIPES]
    ))


def _loaded_documents(
    spark: SparkSession, sf: str, documents: DataFrame, run_type: str, kind: P.Kind
) -> Warehouse:
    """A warehouse after one run over ``documents``."""
    landing = land_as_table(documents)
    start, end = _range(spark, sf, kind)
    warehouse = _new_warehouse(spark, sf, start, end)
    run_etl(warehouse, landing, run_type, start=start, end=end)
    return warehouse


def _numbered(documents: DataFrame, label: str) -> DataFrame:
    return documents.withColumn("doc_id", F.concat(F.lit(f"{label}/"), F.col("doc_id")))


@job_query
def etl_overlap(spark, sf):
    """Documents that overlap in one run: months, weeks within them and batches over both.

    The three say different things of a day; a batch is preferred, then the shorter range.
    """
    cents = A.daily_cents(spark, sf)
    week = cents.where((F.col("district_id") % 3 == 0) & (F.dayofmonth("observed_date") <= 7))
    batch = cents.where((F.col("district_id") % 5 == 0) & (F.dayofmonth("observed_date") > 3))

    def rows(source: DataFrame, more: int) -> DataFrame:
        return A.daily_rows(source.withColumn("cents", F.col("cents") + more))

    feed = "archive-daily"
    weeks = D.single_documents(rows(week, 1), P.DAILY, feed)
    weeks = weeks.withColumn("end_date", F.date_add("start_date", 6))
    documents = (
        D.single_documents(rows(cents, 0), P.DAILY, feed)
        .unionByName(_numbered(weeks, "week"))
        .unionByName(_numbered(D.batch_documents(rows(batch, 2), P.DAILY, feed), "batch"))
    )
    warehouse = _loaded_documents(spark, sf, documents, "historical-daily", P.DAILY)
    return _fact(warehouse, P.DAILY, [r.measure for r in A.DAILY_RECIPES])


def _malformed(spark: SparkSession, sf: str) -> Warehouse:
    """An hourly run whose documents write times in several ways, some of them not as times.

    Documents of users divisible by 7 are spoilt on days divisible by 4.
    """
    series = D.series_per_district(A.hourly_rows(spark, sf), P.HOURLY)
    number = F.col("district_id") % 5

    def written(text):
        return (
            F.when(number == 1, F.concat(text, F.lit(":00")))
            .when(number == 2, F.replace(text, F.lit("T"), F.lit(" ")))
            .when(number == 3, F.concat(text, F.lit("+07:00")))
            .when(number == 4, F.concat(text, F.lit(":00.000+0700")))
            .otherwise(text)
        )

    spoilt = (F.col("district_id") % 7 == 0) & (F.dayofmonth("start_date") % 4 == 0)
    times = F.transform("series.time", written)
    times = F.when(
        spoilt, F.concat(F.slice(times, 1, F.size(times) - 1), F.array(F.lit("25 o'clock")))
    ).otherwise(times)
    series = series.withColumn("series", F.col("series").withField("time", times))
    documents = D.landing(series, P.HOURLY, "archive-hourly")
    return _loaded_documents(spark, sf, documents, "historical-hourly", P.HOURLY)


@job_query
def etl_malformed(spark, sf):
    """What an hourly run loads when some documents hold a malformed time."""
    return _fact(_malformed(spark, sf), P.HOURLY, [r.measure for r in A.HOURLY_RECIPES])


@job_query
def etl_rejected_documents(spark, sf):
    """The documents such a run could not use, from its log."""
    logs = _malformed(spark, sf).monitoring("etl_logs")
    return logs.where(F.col("event_name") == "document_rejected").select(
        F.col("context")["doc_id"].alias("doc_id"),
        F.col("context")["district_id"].cast("int").alias("district_id"),
        F.col("context")["error"].alias("error"),
        "level",
    )


def _forecast_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Each month a forecast; the newest of districts divisible by 4 is cut short, and the
    second newest of those divisible by 8 claims a district too many."""
    rows = A.daily_fact(spark, sf)
    documents = D.single_documents(rows, P.DAILY, "forecast-daily")
    number = F.col("district_ids")[0]
    newest = Window.partitionBy("district_ids").orderBy(F.desc("start_date"))
    ranked = documents.withColumn("rank", F.row_number().over(newest))
    cut = (number % 4 == 0) & (F.col("rank") == 1)
    claims = (number % 8 == 0) & (F.col("rank") == 2)
    return ranked.withColumns(
        {
            "body": F.when(cut, F.substring("body", F.lit(1), F.length("body") - 3)).otherwise(
                F.col("body")
            ),
            "district_ids": F.when(claims, F.array(number, number)).otherwise(
                F.col("district_ids")
            ),
        }
    ).drop("rank")


@job_query
def etl_forecast(spark, sf):
    """A forecast run: of each district the newest document that can be used."""
    documents = _forecast_documents(spark, sf)
    warehouse = _loaded_documents(spark, sf, documents, "forecast-daily", P.DAILY)
    return _fact(warehouse, P.DAILY, [r.measure for r in A.DAILY_RECIPES])


@job_query
def history_skip(spark, sf):
    """A full history after a part of the districts has been loaded: those are left as they are."""
    cents = A.daily_cents(spark, sf)
    feed = "archive-daily"
    first = D.single_documents(A.daily_rows(cents.where("district_id % 2 = 0")), P.DAILY, feed)
    changed = A.daily_rows(cents.withColumn("cents", F.col("cents") + 1))
    start, end = _range(spark, sf, P.DAILY)
    warehouse = _new_warehouse(spark, sf, start, end)
    run_etl(warehouse, land_as_table(first), "historical-daily", start=start, end=end)
    again = land_as_table(D.single_documents(changed, P.DAILY, feed))
    load_history(warehouse, again, "daily", start=start, end=end, skip_existing=True)
    return _fact(warehouse, P.DAILY, [r.measure for r in A.DAILY_RECIPES])


@job_query
def seed_from_csv(spark, sf):
    """Districts handed in as CSV, checked, seeded and read back."""
    folder = fresh_folder(spark, "seed")
    known = valid_rows(A.districts(spark, sf), COORDINATE_RULES)
    known.write.option("header", "true").csv(folder)
    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"))
    seed_districts(warehouse, read_districts_csv(spark, folder))
    return warehouse.table(DIM_DISTRICT)


@job_query
def sync_summary(spark, sf):
    """What the second of two copies read, by table."""
    start, end = _range(spark, sf, P.DAILY)
    documents = D.single_documents(A.daily_fact(spark, sf), P.DAILY, "archive-daily")
    landing = Staging(spark, "landing").put(documents, "documents")
    source = _new_warehouse(spark, sf, start, end)
    target = Warehouse(spark, fresh_folder(spark, "warehouse"))
    later = datetime.combine(end, datetime.min.time(), timezone.utc) + timedelta(days=30)
    for first, last in ((start, SPLIT), (SPLIT + timedelta(days=1), end)):
        run_etl(source, landing, "historical-daily", start=first, end=last)
        results = sync_warehouses(source, target, now=later)
    return summary_of(spark, results)


def _landed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of all three kinds from the events."""
    daily = D.single_documents(A.daily_of_events(spark, sf), P.DAILY, "archive-daily")
    hourly = D.batch_documents(A.hourly_rows(spark, sf), P.HOURLY, "archive-hourly")
    aqi = D.batch_documents(A.aqi_rows(spark, sf), P.AQI, "archive-aqi-hourly")
    return land_as_table(daily.unionByName(hourly).unionByName(aqi))


def _load_all(warehouse: Warehouse, landing: DataFrame, start: date, end: date) -> None:
    for kind in _ROWS:
        run_etl(warehouse, landing, f"historical-{kind}", start=start, end=end)


@job_query
def release_manifest(spark, sf):
    """The manifest of a first release, found by the pointer and read as a table."""
    start, end = _range(spark, sf, P.HOURLY)
    warehouse = _new_warehouse(spark, sf, start, end)
    _load_all(warehouse, _landed_events(spark, sf), start, end)
    store = ReleaseStore(spark, fresh_folder(spark, "releases"))
    bootstrap(warehouse, store, "warehouse")
    listed = read_manifest(spark, store.at(store.read_latest()[0]["manifest_key"]))
    return listed.select("name", "row_count", "min_date", "max_date")


@job_query
def release_summary(spark, sf):
    """Rows and last date of each table of a first release, and whether it has files."""
    start, end = _range(spark, sf, P.HOURLY)
    warehouse = _new_warehouse(spark, sf, start, end)
    _load_all(warehouse, _landed_events(spark, sf), start, end)
    store = ReleaseStore(spark, fresh_folder(spark, "releases"))
    bootstrap(warehouse, store, "warehouse")
    summary = summarised(read_manifest(spark, store.at(store.read_latest()[0]["manifest_key"])))
    return summary.select("name", "rows", (F.col("bytes") > 0).alias("has_files"), "max_date")


def _published(spark: SparkSession, store: ReleaseStore, spec, measures: list[str]) -> DataFrame:
    """The current CSV copy of an hourly fact, by time instead of by hour key."""

    def current(table):
        return read_release_csv(spark, store.at(f"{CURRENT}/{table.name}.csv"), table)

    rows = current(spec).join(current(DIM_HOUR).select("hour_key", "observed_at"), "hour_key")
    return _plain(rows.select("district_id", "observed_at", *measures))


@job_query
def release_publish(spark, sf):
    """A first release, the days after it published by a second, and the current CSV copy."""
    start, end = _range(spark, sf, P.HOURLY)
    warehouse = _new_warehouse(spark, sf, start, end)
    landing = _landed_events(spark, sf)
    store = ReleaseStore(spark, fresh_folder(spark, "releases"))
    moment = datetime.combine(end, datetime.min.time(), timezone.utc)
    _load_all(warehouse, landing, start, FIRST_RELEASE_END)
    bootstrap(warehouse, store, "warehouse", now=moment)
    _load_all(warehouse, landing, FIRST_RELEASE_END + timedelta(days=1), end)
    manifest = publish(warehouse, store, "warehouse", target=end, now=moment + timedelta(days=1))
    store.verify(manifest)
    return _published(spark, store, FACT_HOURLY, [r.measure for r in A.HOURLY_RECIPES])


@job_query
def catch_up_release(spark, sf):
    """A window that was missed, run and published again by the catch-up job."""
    start, end = _range(spark, sf, P.HOURLY)
    warehouse = _new_warehouse(spark, sf, start, end)
    landing = _landed_events(spark, sf)
    store = ReleaseStore(spark, fresh_folder(spark, "releases"))
    _load_all(warehouse, landing, start, FIRST_RELEASE_END)
    moment = datetime.combine(end, datetime.min.time(), timezone.utc)
    bootstrap(warehouse, store, "warehouse", now=moment)
    missed = FIRST_RELEASE_END + timedelta(days=1)
    catch_up(warehouse, landing, missed, end, store=store)
    return _published(spark, store, FACT_AQI, [r.measure for r in A.AQI_RECIPES])


@job_query
def backfill_repair(spark, sf):
    """A measure that the stored fact and the release didn't have, filled for a range of days
    and republished."""
    added = "wind_direction_10m"
    start, end = _range(spark, sf, P.HOURLY)
    landing = _landed_events(spark, sf)
    filled = _new_warehouse(spark, sf, start, end)
    _load_all(filled, landing, start, end)
    # The same warehouse as it was stored before the measure existed.
    older = replace(
        FACT_HOURLY, stored=T.StructType([f for f in FACT_HOURLY.stored if f.name != added])
    )
    warehouse = _new_warehouse(spark, sf, start, end)
    warehouse.write_version(DIM_HOUR, filled.table(DIM_HOUR))
    warehouse.upsert(older, filled.physical(older))
    for spec in (FACT_DAILY, FACT_AQI):
        warehouse.upsert(spec, filled.physical(spec))
    store = ReleaseStore(spark, fresh_folder(spark, "releases"))
    moment = datetime.combine(end, datetime.min.time(), timezone.utc)
    bootstrap(warehouse, store, "warehouse", now=moment)
    backfill_hourly(warehouse, landing, BACKFILL_START, FIRST_RELEASE_END, store=store)
    return _published(spark, store, FACT_HOURLY, ["temperature_2m", added])
