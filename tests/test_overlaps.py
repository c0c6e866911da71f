"""Runs narrower than a document, empty targets and long lists of unknown ids."""

from datetime import UTC, date, datetime

import pytest
from helpers import daily_body, days, district_frame, landing, new_warehouse

from airledger.operators.districts import select_districts
from airledger.operators.sync import sync_delta
from airledger.plans.etl import run_etl
from airledger.schemas import DIM_DATE, FACT_DAILY


def test_a_run_takes_its_days_from_a_wider_document(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    span = days(date(2024, 2, 3), 9)
    body = daily_body(span, temperature_2m_max=[14.5 + i for i in range(9)])
    frame = landing(spark, ("wide", "archive-daily", [1, 2, 3], span[0], span[-1], [body] * 3))
    run_etl(warehouse, frame, "incremental-daily", start=span[4], end=span[5])
    loaded = warehouse.table(FACT_DAILY).select("date_key").distinct().collect()
    assert sorted(r.date_key for r in loaded) == [20240207, 20240208]


def test_a_null_mark_takes_everything(spark):
    made = [(20240201, date(2024, 2, 1)), (20240202, date(2024, 2, 2))]
    source = spark.createDataFrame(made, "date_key int, date date")
    marks = source.limit(0).selectExpr("max(date_key) AS last_key")
    assert sync_delta(source, DIM_DATE, marks, datetime(2030, 1, 1, tzinfo=UTC)).count() == 2


def test_all_unknown_ids_are_listed(spark):
    with pytest.raises(ValueError) as failure:
        select_districts(district_frame(spark), [1, *range(40, 52)], None)
    assert all(str(i) in str(failure.value) for i in range(40, 52))
