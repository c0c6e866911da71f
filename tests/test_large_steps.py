"""Steps whose tasks have to follow the number of rows, on rows made for the purpose."""

from datetime import date

import pytest
from helpers import daily_body, days, landing, new_warehouse
from pyspark.sql import functions as F

from airledger.operators.payload import DAILY
from airledger.plans.etl import _dealt_out, _unpivoted
from airledger.schemas import FACT_DAILY
from airledger.sinks import warehouse as W

JAN = date(2024, 1, 1)


@pytest.fixture
def many_partitions(spark):
    """No partitions are joined, so that those that rows are dealt to can be seen."""
    wanted = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def _facts(spark, month_days, districts):
    """One row per district and day, with the month it belongs to."""
    rows = [
        (number, int(day.strftime("%Y%m%d")), day, float(number), int(day.strftime("%Y%m")))
        for day in month_days
        for number in districts
    ]
    schema = (
        "district_id int, date_key int, observed_date date, temperature_2m_mean float, "
        "month_key int"
    )
    return spark.createDataFrame(rows, schema)


def test_a_large_month_is_written_by_several_tasks(spark, tmp_path, monkeypatch, many_partitions):
    monkeypatch.setattr(W, "ROWS_PER_PIECE", 10)
    warehouse = new_warehouse(spark, tmp_path)
    large, small = days(JAN, 31), days(date(2024, 2, 1), 2)
    delta = _facts(spark, large + small, (1, 2, 3))
    warehouse.upsert(FACT_DAILY, delta)
    base = tmp_path / "analyst" / FACT_DAILY.name
    assert len(list(base.glob("load=*1/month_key=202401/part-*"))) > 1
    assert len(list(base.glob("load=*1/month_key=202402/part-*"))) == 1

    # A few new rows: the month is as large as before.
    warehouse.upsert(FACT_DAILY, _facts(spark, large[:1], (1,)).withColumn(
        "temperature_2m_mean", F.lit(9.5).cast("float")
    ))
    assert len(list(base.glob("load=*2/month_key=202401/part-*"))) > 1
    stored = warehouse.table(FACT_DAILY)
    assert stored.count() == delta.count() == 99
    assert stored.select("district_id", "date_key").distinct().count() == 99
    assert stored.where("temperature_2m_mean = 9.5").count() == 1


def test_documents_of_one_file_are_parsed_by_several_tasks(spark, many_partitions):
    documents = landing(
        spark,
        *[
            (f"d{i}", "archive-daily", [1], day, day, daily_body([day], rain_sum=[float(i)]))
            for i, day in enumerate(days(JAN, 40))
        ],
    ).coalesce(1)
    places = F.broadcast(spark.createDataFrame([(1,)], "district_id int"))
    parsed = _unpivoted(_dealt_out(documents), DAILY, places)
    parsed = parsed.withColumn("task", F.spark_partition_id())
    found = parsed.select("task", "rain_sum").collect()
    assert sorted(r.rain_sum for r in found) == [float(i) for i in range(40)]
    assert len({r.task for r in found}) > 1
