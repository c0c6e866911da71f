import json
import re
from datetime import date, datetime, timedelta, timezone

import pytest
from helpers import (
    DISTRICTS,
    daily_body,
    days,
    district_frame,
    hourly_body,
    hours_of,
    landing,
    new_warehouse,
    rows,
)
from pyspark.sql import functions as F

from airledger.operators.monitoring import SCHEDULED_RUN_TYPES
from airledger.operators.reads import hourly_range
from airledger.plans.catchup import backfill_hourly, catch_up
from airledger.plans.etl import RUN_TYPES, load_history, run_dates, run_etl, seed_districts
from airledger.plans.report import workflow_report
from airledger.plans.sync import sync_totals, sync_warehouses
from airledger.schemas import (
    DIM_DATE,
    DIM_DISTRICT,
    DIM_HOUR,
    FACT_AQI,
    FACT_DAILY,
    FACT_HOURLY,
    FOREIGN_KEYS,
    SPECS,
    TABLE_SPECS,
)
from airledger.operators.quality import orphans
from airledger.sinks.warehouse import Warehouse
from airledger.streaming.landing_stream import load_new_documents

JAN = date(2024, 1, 1)
IDS = [d[0] for d in DISTRICTS]


def daily_doc(start, count, values, ids=(1,), feed="archive-daily", name=None):
    end = start + timedelta(days=count - 1)
    bodies = [daily_body(days(start, count), rain_sum=v) for v in values]
    body = bodies if len(ids) > 1 else bodies[0]
    return (name or f"{feed}{ids}{start}", feed, list(ids), start, end, body)


def hourly_doc(day, value, ids=(1,), kind="hourly", measure="temperature_2m"):
    bodies = [hourly_body(hours_of(day), **{measure: [value + i] * 24}) for i in range(len(ids))]
    body = bodies if len(ids) > 1 else bodies[0]
    feed = f"archive-{kind}"
    return (f"{feed}{ids}{day}{value}", feed, list(ids), day, day, body)


def scheduled_documents(*dates, value=10.0, ids=IDS):
    out = []
    for day in dates:
        out.append(daily_doc(day, 1, [[value + i] for i in range(len(ids))], ids))
        out.append(hourly_doc(day, value, ids))
        out.append(hourly_doc(day, value, ids, "aqi-hourly", "pm10"))
    return out


# -- run types and dates -------------------------------------------------------------------


def test_run_dates():
    yesterday = date(2025, 3, 14)
    assert len(RUN_TYPES) == 9
    assert run_dates("historical-daily", yesterday=yesterday) == (date(2023, 6, 1), yesterday)
    assert run_dates("incremental-hourly", yesterday=yesterday) == (yesterday, yesterday)
    assert run_dates("forecast-aqi-hourly", yesterday=yesterday) == (yesterday, yesterday)
    assert run_dates("incremental-daily", JAN, JAN) == (JAN, JAN)
    with pytest.raises(ValueError, match="together"):
        run_dates("incremental-daily", JAN)
    with pytest.raises(ValueError, match="before or equal"):
        run_dates("incremental-daily", JAN, JAN - timedelta(days=1))
    with pytest.raises(ValueError, match="unsupported"):
        run_dates("monthly-daily")


# -- etl -----------------------------------------------------------------------------------


def test_daily_run_loads_rejects_and_logs(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    documents = landing(
        spark,
        # Too few elements: both districts must come from their own documents, one has none.
        ("batch", "archive-daily", [1, 2], JAN, JAN + timedelta(days=2), [daily_body([JAN])]),
        daily_doc(JAN, 3, [[1.0, 900.0, None]], (1,)),
        ("broken", "archive-daily", [3], JAN, JAN, "{"),
        # Outside the requested range, or of another feed.
        daily_doc(date(2024, 2, 1), 1, [[5.0]], (1,)),
        daily_doc(JAN, 1, [[7.0]], (2,), feed="forecast-daily"),
    )
    got = run_etl(wh, documents, "historical-daily", start=JAN, end=date(2024, 1, 31))
    assert (got.rows_loaded, got.rows_skipped, got.total_rejected) == (2, 3, 1)
    assert rows(wh.table(FACT_DAILY), "district_id", "date_key", "rain_sum") == [
        (1, 20240101, 1.0), (1, 20240103, None),
    ]
    errors = wh.monitoring("validation_errors")
    assert rows(errors, "etl_run_id", "source_table", "field_name", "invalid_value") == [
        (got.run_id, "analyst.fact_weather_daily", "rain_sum", "900.0"),
    ]
    logs = wh.monitoring("etl_logs").where("level = 'ERROR'")
    assert rows(logs, F.element_at("context", "district_id"), F.element_at("context", "error")) == [
        ("2", "document holds 1 payloads for 2 districts"),
        ("3", "document is not valid JSON"),
    ]
    run = wh.monitoring("etl_runs").where("status = 'completed'").first()
    assert (run.rows_inserted, run.rows_skipped, run.etl_run_id) == (2, 3, got.run_id)


def test_reloading_replaces_whole_rows_in_their_month_only(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    first = landing(
        spark, daily_doc(date(2024, 1, 30), 4, [[1.0, 2.0, 3.0, 4.0]] * 2, (1, 2))
    )
    run_etl(wh, first, "historical-daily", start=JAN, end=date(2024, 2, 28))
    untouched = {
        f: (tmp_path / "wh").stat().st_mtime for f in wh.table(FACT_DAILY).inputFiles()
        if "month_key=202401" in f
    }
    second = landing(spark, daily_doc(date(2024, 2, 1), 2, [[None, 40.0]], (1,)))
    run_etl(wh, second, "historical-daily", start=JAN, end=date(2024, 2, 28))
    got = rows(wh.table(FACT_DAILY).where("date_key > 20240131"), "district_id", "date_key", "rain_sum")
    assert got == [
        (1, 20240201, None), (1, 20240202, 40.0), (2, 20240201, 3.0), (2, 20240202, 4.0),
    ]
    assert wh.table(FACT_DAILY).count() == 8
    assert set(untouched) <= set(wh.table(FACT_DAILY).inputFiles())


def test_overlapping_documents_load_in_one_run(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    overlapping = landing(
        spark, daily_doc(JAN, 31, [[1.0] * 31, [2.0] * 31], (1, 2)),
        daily_doc(date(2024, 1, 2), 1, [[5.0]], (1,)), daily_doc(date(2024, 1, 3), 2, [[6.0] * 2], (3,)),
        daily_doc(date(2024, 1, 4), 1, [[7.0]], (3,)),
    )
    got = run_etl(wh, overlapping, "historical-daily", start=JAN, end=date(2024, 1, 9))
    assert (got.rows_loaded, got.failed_districts) == (20, 0)
    assert rows(wh.table(FACT_DAILY).where("district_id <> 2"), "district_id", "date_key", "rain_sum") == [
        *[(1, 20240101 + i, 1.0) for i in range(9)], (3, 20240103, 6.0), (3, 20240104, 7.0),
    ]


def test_malformed_times_are_logged_and_the_rest_loads(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    odd = daily_body([JAN, JAN], rain_sum=[8.0, 9.0])
    odd["daily"]["time"][1] = "01/02/2024"
    good = daily_body(days(JAN, 2), rain_sum=[1.0, 2.0])
    documents = landing(
        spark, ("two", "archive-daily", [1, 2], JAN, JAN, [good, odd]),
        ("lone", "archive-daily", [2], JAN, date(2024, 1, 3), good),
        ("last", "archive-daily", [3], JAN, JAN, odd),
        ("strange", "archive-daily", [77], JAN, JAN, good),
    )
    got = run_etl(wh, documents, "historical-daily", start=JAN, end=date(2024, 1, 9))
    assert (got.rows_loaded, got.failed_districts) == (4, 1)
    assert rows(wh.table(FACT_DAILY), "district_id", "rain_sum") == [
        (1, 1.0), (1, 2.0), (2, 1.0), (2, 2.0),
    ]
    logs = wh.monitoring("etl_logs")
    said = F.element_at("context", "error")
    rejected = logs.where("event_name = 'document_rejected'")
    assert rows(rejected, F.element_at("context", "doc_id"), F.element_at("context", "district_id"), said) == [
        ("last", "3", "malformed date: 01/02/2024"), ("two", "2", "malformed date: 01/02/2024"),
    ]
    failed = logs.where("event_name = 'extract_failed'")
    assert rows(failed, said) == [("malformed date: 01/02/2024",)]
    unknown = logs.where("event_name = 'unknown_district'")
    assert rows(unknown, F.element_at("context", "district_id")) == [("77",)]


def test_days_outside_the_calendar_fail_the_run(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    late = landing(spark, daily_doc(date(2025, 1, 1), 1, [[1.0]]))
    with pytest.raises(ValueError, match="missing from dim_date"):
        run_etl(wh, late, "historical-daily", start=JAN, end=date(2025, 12, 31))


def test_hourly_backfill_gets_larger_keys(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    for day in (date(2024, 1, 5), date(2024, 1, 3)):
        documents = landing(spark, hourly_doc(day, 20.0, (1, 2)))
        assert run_etl(wh, documents, "incremental-hourly", start=day, end=day).rows_loaded == 48
    again = landing(spark, hourly_doc(date(2024, 1, 5), 30.0, (1,)))
    run_etl(wh, again, "incremental-hourly", start=JAN, end=date(2024, 1, 9))
    hours = wh.table(DIM_HOUR)
    spans = hours.groupBy("observed_date").agg(F.min("hour_key"), F.max("hour_key"))
    assert rows(spans, "*") == [(date(2024, 1, 3), 25, 48), (date(2024, 1, 5), 1, 24)]
    late = landing(spark, hourly_doc(date(2024, 2, 3), 25.0, (1,)))
    run_etl(wh, late, "incremental-hourly", start=date(2024, 2, 3), end=date(2024, 2, 3))
    january = hourly_range(
        wh.physical(FACT_HOURLY), wh.table(DIM_HOUR), 1, None, date(2024, 1, 31), limit=1000
    )
    assert january.count() == 48 and "month_key" not in january.columns
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = january._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^]]*month_key#\d+ <= 202401", plan)
    wh_fact = wh.table(FACT_HOURLY).join(hours.select("hour_key"), "hour_key")
    fact = wh_fact.groupBy("district_id", "temperature_2m").count()
    assert rows(fact, "*") == [(1, 20.0, 24), (1, 30.0, 24), (2, 21.0, 48)]


def test_aqi_hours_share_the_hour_dimension(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    documents = landing(
        spark, hourly_doc(JAN, 20.0), hourly_doc(JAN, 5.0, (1,), "aqi-hourly", "pm10"),
        hourly_doc(date(2024, 1, 2), 6.0, (1,), "aqi-hourly", "pm10"),
    )
    for kind in ("hourly", "aqi-hourly"):
        run_etl(wh, documents, f"historical-{kind}", start=JAN, end=date(2024, 1, 9))
    assert wh.table(DIM_HOUR).count() == 48
    assert wh.table(FACT_AQI).count() == 48
    for child, column, parent, parent_column in FOREIGN_KEYS:
        missing = orphans(
            wh.table(SPECS[child]), column, wh.table(SPECS[parent]), parent_column
        )
        assert missing.count() == 0, (child, column)


def test_forecast_uses_the_newest_document_whatever_the_range(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    documents = landing(
        spark,
        daily_doc(date(2024, 2, 1), 3, [[1.0, 1.0, 1.0]], feed="forecast-daily"),
        daily_doc(date(2024, 2, 2), 3, [[2.0, 2.0, 2.0]], feed="forecast-daily"),
        daily_doc(date(2024, 2, 1), 2, [[9.0, 9.0]], (2,), feed="forecast-daily"),
    )
    got = run_etl(wh, documents, "forecast-daily", start=JAN, end=JAN)
    assert got.rows_loaded == 5 and got.failed_districts == 1
    assert rows(wh.table(FACT_DAILY).where("district_id = 1"), "date_key", "rain_sum") == [
        (20240202, 2.0), (20240203, 2.0), (20240204, 2.0),
    ]


def test_forecasts_step_back_where_the_newest_cannot_be_used(spark, tmp_path):
    """Only documents that are needed are parsed, so older unusable ones aren't noticed."""
    wh = new_warehouse(spark, tmp_path / "wh")
    feed = "forecast-daily"
    second, third = date(2024, 2, 2), date(2024, 2, 3)
    documents = landing(
        spark, ("old", feed, [1], JAN, JAN, "{"), daily_doc(date(2024, 2, 1), 1, [[1.0]], feed=feed),
        ("cut", feed, [1], second, second, "{"), ("bad", feed, [1], third, third, {"daily": {"time": ["?"]}}),
        daily_doc(second, 1, [[2.0], [3.0]], (2, 3), feed=feed), ("new", feed, [3], third, third, "["),
    )
    got = run_etl(wh, documents, "forecast-daily", start=JAN, end=JAN)
    assert (got.rows_loaded, got.failed_districts) == (3, 0)
    assert rows(wh.table(FACT_DAILY), "district_id", "date_key", "rain_sum") == [
        (1, 20240201, 1.0), (2, 20240202, 2.0), (3, 20240202, 3.0),
    ]
    logs = wh.monitoring("etl_logs").where("event_name = 'document_rejected'")
    assert rows(logs, F.element_at("context", "doc_id")) == [("bad",), ("cut",), ("new",)]


def test_writes_refuse_rows_without_parents(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    fact = spark.createDataFrame(
        [(1, 20240101, 202401), (40, 20240101, 202401), (40, 20240102, 202401)],
        "district_id int, date_key int, month_key int",
    )
    with pytest.raises(ValueError, match=r"missing from dim_district \(1\).*'district_id', 40, 2"):
        wh.upsert(FACT_DAILY, fact)
    hourly = spark.createDataFrame([(1, 7, 202401)], "district_id int, hour_key int, month_key int")
    for spec in (FACT_HOURLY, FACT_AQI):
        with pytest.raises(ValueError, match="missing from dim_hour"):
            wh.upsert(spec, hourly)
    hours = spark.sql("SELECT 1 AS hour_key, 20990101 AS date_key, DATE'2099-01-01' AS observed_date, now() AS observed_at")
    with pytest.raises(ValueError, match="missing from dim_date"):
        wh.upsert(DIM_HOUR, hours)
    assert wh.table(FACT_DAILY).count() == wh.table(DIM_HOUR).count() == 0


def test_district_selection(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    documents = landing(spark, daily_doc(JAN, 1, [[1.0], [2.0], [3.0]], IDS))
    run_etl(wh, documents, "historical-daily", start=JAN, end=JAN, district_ids=[3, 2], first=1)
    assert rows(wh.table(FACT_DAILY), "district_id") == [(2,)]
    with pytest.raises(ValueError, match="unknown district"):
        run_etl(wh, documents, "historical-daily", start=JAN, end=JAN, district_ids=[77])


def test_district_that_delivered_nothing_is_not_a_failure(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    documents = landing(spark, ("empty", "archive-daily", IDS, JAN, JAN, [{}, {}, {}]))
    got = run_etl(wh, documents, "historical-daily", start=JAN, end=JAN)
    assert (got.rows_loaded, got.rows_skipped, got.failed_districts) == (0, 0, 0)


def test_history_skips_loaded_districts(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    run_etl(wh, landing(spark, daily_doc(JAN, 1, [[1.0]])), "historical-daily", start=JAN, end=JAN)
    documents = landing(spark, daily_doc(JAN, 1, [[7.0], [8.0], [9.0]], IDS))
    load_history(wh, documents, "daily", start=JAN, end=date(2024, 4, 30), skip_existing=True)
    assert rows(wh.table(FACT_DAILY), "district_id", "rain_sum") == [(1, 1.0), (2, 8.0), (3, 9.0)]
    assert wh.table(DIM_DATE).agg(F.max("date")).first()[0] == date(2024, 4, 30)


def test_districts_outside_the_area_are_refused(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(ValueError, match="permitted area"):
        seed_districts(wh, district_frame(spark, [(9, "Far", 10.0, 105.5)]))


def test_insert_ignore_leaves_rows_untouched(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh", JAN, date(2024, 1, 2))
    changed = wh.table(DIM_DATE).withColumn("quarter", F.lit(9))
    more = changed.unionByName(
        changed.limit(1).withColumns(
            {"date_key": F.lit(20240103), "date": F.lit(date(2024, 1, 3))}
        )
    )
    wh.insert_ignore(DIM_DATE, more)
    assert rows(wh.table(DIM_DATE), "date_key", "quarter") == [
        (20240101, 1), (20240102, 1), (20240103, 9),
    ]


def test_unfinished_versions_are_not_read(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    base = tmp_path / "wh/analyst/dim_district"
    (base / "version=00000002").mkdir()
    assert wh.table(DIM_DISTRICT).count() == 3
    for i in range(4):
        wh.upsert(DIM_DISTRICT, district_frame(spark, [(1, f"Name {i}", 21.0, 105.8)]))
    assert rows(wh.table(DIM_DISTRICT).where("district_id = 1"), "district_name") == [("Name 3",)]
    finished = [v for v in base.glob("version=*") if (v / "_SUCCESS").exists()]
    assert len(finished) == 3


# -- sync ----------------------------------------------------------------------------------


def _tables(warehouse):
    return {s.name: rows(warehouse.table(s), *s.columns) for s in TABLE_SPECS}


def test_sync_copies_what_is_missing(spark, tmp_path):
    source, target = new_warehouse(spark, tmp_path / "a"), Warehouse(spark, str(tmp_path / "b"))
    first, second = date(2024, 1, 10), date(2024, 2, 11)
    now = datetime(2024, 3, 1, tzinfo=timezone.utc)

    def load(value, *dates, run_types=("incremental-hourly",)):
        documents = landing(spark, *[d for day in dates for d in scheduled_documents(day, value=value)])
        for run_type in run_types:
            run_etl(source, documents, run_type, start=min(dates), end=max(dates))

    load(10.0, first, run_types=SCHEDULED_RUN_TYPES)
    results = sync_warehouses(source, target, now=now)
    assert [r.table for r in results] == [s.name for s in TABLE_SPECS]
    assert sync_totals(results)["rows_read"] == sum(len(v) for v in _tables(source).values())
    assert _tables(target) == _tables(source)
    # A new day and a backfilled earlier one arrive by key, and calendar days by cutoff; a
    # changed old row does not, until a longer look back asks for it.
    load(12.0, second)
    load(30.0, first, date(2024, 1, 2))
    again = {r.table: r.rows_read for r in sync_warehouses(source, target, now=now)}
    assert again == {
        "dim_district": 3, "dim_date": 31, "dim_hour": 48, "fact_weather_daily": 0,
        "fact_weather_hourly": 144, "fact_aqi_hourly": 0,
    }
    copied, loaded = _tables(target), _tables(source)
    assert copied["dim_hour"] == loaded["dim_hour"]
    assert len(copied["fact_weather_hourly"]) == len(loaded["fact_weather_hourly"])
    assert copied["fact_weather_hourly"] != loaded["fact_weather_hourly"]
    sync_warehouses(source, target, now=now, lookback_days=60)
    assert _tables(target) == loaded


def test_sync_guards(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "a")
    other = Warehouse(spark, str(tmp_path / "b"))
    with pytest.raises(ValueError, match="different"):
        sync_warehouses(wh, wh)
    with pytest.raises(ValueError, match="negative"):
        sync_warehouses(wh, other, lookback_days=-1)
    with pytest.raises(ValueError, match="time zone"):
        sync_warehouses(wh, other, now=datetime(2024, 1, 1))


# -- monitoring ----------------------------------------------------------------------------


def test_workflow_report(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    t0 = datetime(2024, 1, 2, 18, 0, tzinfo=timezone.utc)
    old = wh.start_run("incremental-daily", now=t0 - timedelta(days=1))
    wh.complete_run(old, "completed", inserted=5, now=t0)
    run = wh.start_run("incremental-daily", now=t0)
    wh.complete_run(run, "completed", now=t0 + timedelta(minutes=1))
    wh.complete_run(999, "completed")
    reports = tmp_path / "reports/nested"
    reports.mkdir(parents=True)
    (reports / "job.json").write_text(
        json.dumps({"job_id": "j", "started_at_utc": "2024-01-02T17:59:00+00:00"}, indent=2)
    )
    (reports / "other.json").write_text(json.dumps({"name": "not a job"}))
    report = workflow_report(
        wh, t0 - timedelta(days=9), job_reports=str(tmp_path / "reports")
    )
    assert rows(report.jobs, "job_id") == [("j",)]
    assert rows(report.runs, "etl_run_id", "status", "started", "completed_empty") == [
        (run, "completed", "03/01/2024 01:00:00 (UTC+7)", True),
    ]
    assert rows(report.totals, "runs", "rows_inserted", "run_types") == [(1, 0, "incremental-daily")]
    assert rows(report.catchup, "needed", "catchup_date") == [(False, None)]
    assert rows(report.snapshot, "*") == [
        ("Daily weather", 0, "-"), ("Hourly AQI", 0, "-"), ("Hourly weather", 0, "-"),
    ]
    failed = wh.start_run("incremental-hourly", now=t0)
    wh.complete_run(failed, "failed", error_summary="x")
    needed = workflow_report(wh, t0).catchup
    assert rows(needed, "needed", "catchup_date") == [(True, "2024-01-02")]
    assert workflow_report(wh, t0, scheduled=False).catchup.first().needed is False
    assert workflow_report(wh, t0 + timedelta(days=3)).catchup.first().needed is True


# -- catch-up, backfill, stream ------------------------------------------------------------


def test_catch_up_runs_all_scheduled_kinds(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    documents = landing(spark, *scheduled_documents(JAN))
    results, manifest = catch_up(wh, documents, JAN, JAN, districts=district_frame(spark))
    assert [r.rows_loaded for r in results] == [3, 72, 72] and manifest is None
    assert wh.table(FACT_DAILY).count() == 3


def test_backfill_fills_a_measure_added_later(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    run_etl(wh, landing(spark, hourly_doc(JAN, 20.0)), "historical-hourly", start=JAN, end=JAN)
    body = hourly_body(hours_of(JAN), temperature_2m=[20.0] * 24, wind_direction_10m=[90.0] * 24)
    later = landing(spark, ("late", "archive-hourly", [1], JAN, JAN, body))
    result, _ = backfill_hourly(wh, later, JAN, JAN)
    assert result.rows_loaded == 24
    assert rows(wh.table(FACT_HOURLY).distinct(), "wind_direction_10m")[0] == (90.0,)
    with pytest.raises(ValueError):
        backfill_hourly(wh, later, JAN, JAN - timedelta(days=1))


def test_stream_reads_each_landed_document_once(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh")
    land, mark = str(tmp_path / "land"), str(tmp_path / "mark")
    landing(spark, daily_doc(JAN, 2, [[1.0, 2.0]])).coalesce(1).write.parquet(land)
    load_new_documents(wh, land, "historical-daily", mark)
    landing(spark, daily_doc(JAN, 1, [[5.0]], (2,))).coalesce(1).write.mode("append").parquet(land)
    load_new_documents(wh, land, "historical-daily", mark)
    load_new_documents(wh, land, "historical-daily", mark)
    assert rows(wh.table(FACT_DAILY), "district_id", "rain_sum") == [(1, 1.0), (1, 2.0), (2, 5.0)]
    assert wh.monitoring("etl_runs").where("status = 'completed'").count() == 2


def test_a_load_that_stops_between_months_leaves_the_old_state(spark, tmp_path, monkeypatch):
    wh = new_warehouse(spark, tmp_path / "wh")

    def fact(value, *dates):
        keyed = [(i, int(f"{d:%Y%m%d}"), d, float(value), int(f"{d:%Y%m}")) for d in dates for i in IDS]
        return spark.createDataFrame(
            keyed, "district_id int, date_key int, observed_date date, rain_sum float, month_key int"
        )

    span = (date(2024, 1, 5), date(2024, 2, 5), date(2024, 3, 5))
    wh.upsert(FACT_DAILY, fact(1.0, *span))
    # The second month fails while it is written, the first being there already.
    odd = F.when(F.col("month_key") == 202402, F.raise_error(F.lit("disk gone"))).otherwise(2.0)
    broken = fact(2.0, *span).withColumn("rain_sum", odd.cast("float"))
    with pytest.raises(Exception, match="disk gone"):
        wh._write_load(FACT_DAILY, broken, wh._next_load(FACT_DAILY))
    # A load that is written but not switched to isn't seen either.
    with monkeypatch.context() as patch:
        patch.setattr(wh, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("driver gone")))
        with pytest.raises(RuntimeError, match="driver gone"):
            wh.upsert(FACT_DAILY, fact(3.0, *span[:2]))
    assert rows(wh.table(FACT_DAILY).groupBy("rain_sum").count(), "*") == [(1.0, 9)]
    for value in (4.0, 5.0, 6.0, 7.0):
        wh.upsert(FACT_DAILY, fact(value, span[1]))
    got = wh.physical(FACT_DAILY).groupBy("month_key", "rain_sum").count()
    assert rows(got, "*") == [(202401, 1.0, 3), (202402, 7.0, 3), (202403, 1.0, 3)]
    # Only what a kept state refers to is still there.
    base = tmp_path / "wh/analyst/fact_weather_daily"
    months = sorted(p.relative_to(base).parts for p in base.glob("load=*/month_key=*"))
    assert len([m for m in months if m[1] == "month_key=202402"]) == 3
    assert len(months) == 5 and len(list(base.glob("_months-*.json"))) == 3


def test_run_state_is_found_without_sorting(spark):
    from airledger.operators import monitoring as M

    day = datetime(2024, 1, 5, tzinfo=timezone.utc)
    later = [day + timedelta(minutes=m) for m in range(4)]
    runs = spark.createDataFrame(
        [
            (1, "a", "running", day, None, 0, None), (1, "a", "failed", day, later[1], 0, "x"),
            (1, "a", "completed", day, later[2], 7, None), (1, "a", "completed", day, later[2], 7, None),
            (2, "b", "running", later[3], None, 0, None),
        ],
        "etl_run_id bigint, run_type string, status string, started_at timestamp, "
        "finished_at timestamp, rows_inserted bigint, error_summary string",
    )
    state = M.latest_run_state(runs)
    assert state.columns == runs.columns
    assert rows(state, "etl_run_id", "status", "rows_inserted") == [(1, "completed", 7), (2, "running", 0)]
    since = F.lit(day)
    for frame in (state, M.runs_by_type(state, since), M.catchup_needed(state, since, scheduled=True, job_succeeded=True)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan
