from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from airledger.functions import temporal as X
from airledger.operators.calendar import build_dim_date


def _one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first().r


@pytest.mark.parametrize(
    "text, utc",
    [
        ("2024-01-01T00:00", "2023-12-31 17:00:00"),
        ("2024-01-01T00:00:30", "2023-12-31 17:00:30"),
        ("2024-01-01 07:00", "2024-01-01 00:00:00"),
        ("2024-01-01T00:00Z", "2024-01-01 00:00:00"),
        ("2024-01-01T00:00+00:00", "2024-01-01 00:00:00"),
        ("2024-01-01T05:30:00+0530", "2024-01-01 00:00:00"),
        ("2024-01-01T00:00:00.250000-03:00", "2024-01-01 03:00:00.25"),
        ("2024-01-01", "2023-12-31 17:00:00"),
    ],
)
def test_iso_instant(spark, text, utc):
    parsed = F.convert_timezone(None, F.lit("UTC"), X.try_iso_instant(F.col("v")))
    assert _one(spark, parsed.cast("string"), text) == utc


@pytest.mark.parametrize("text", ["2024", "2024-01-01T5:00", "yesterday", "2024-01-32T00:00", None])
def test_malformed_instant_is_null(spark, text):
    assert _one(spark, X.try_iso_instant(F.col("v")), text) is None


def test_iso_dates(spark):
    """The same texts as Python's own ISO parser takes, and the same days."""
    good = ["2024-02-29", "20240229", "2024-W01-1", "2020W537", "2021-W01", "2026W53", "0999-01-05"]
    bad = ["2024-1-1", "2024", "2024-01-01T05:00", "2023-02-29", "2021-W53-1", "2024-W00-1",
           "2024-W01-8", "2024W01-1", "2024-W011", "20240230", "", None]
    for text in good:
        assert _one(spark, X.try_iso_date(F.col("v")), text) == date.fromisoformat(text), text
    for text in bad:
        assert _one(spark, X.try_iso_date(F.col("v")), text) is None, text


def test_local_date_and_display(spark):
    moment = datetime(2024, 1, 1, 18, 30, tzinfo=timezone.utc)
    assert _one(spark, X.local_date(F.col("v")), moment, "timestamp") == date(2024, 1, 2)
    shown = X.display_local(F.col("v"))
    assert _one(spark, shown, moment, "timestamp") == "02/01/2024 01:30:00 (UTC+7)"
    assert _one(spark, shown, None, "timestamp") == "-"
    assert _one(spark, X.catchup_date(F.col("v")), moment, "timestamp") == date(2024, 1, 1)


def test_wall_clock_round_trip(spark):
    wall = datetime(2024, 5, 6, 7, 8, 9)
    there = X.instant_of_wall_clock(F.col("v"))
    assert _one(spark, X.local_wall_clock(there), wall, "timestamp_ntz") == wall
    assert _one(spark, X.start_of_hour(F.col("v")), wall, "timestamp_ntz") == datetime(
        2024, 5, 6, 7
    )


def test_duration_is_truncated_and_never_negative(spark):
    a = datetime(2024, 1, 1, tzinfo=timezone.utc)
    b = datetime(2024, 1, 1, 0, 1, 35, 900000, tzinfo=timezone.utc)
    df = spark.createDataFrame([(a, b), (b, a)], "s timestamp, f timestamp")
    got = df.select(X.duration_seconds(F.col("s"), F.col("f")).alias("d")).collect()
    assert [r.d for r in got] == [95, 0]


def test_calendar(spark):
    rows = {r.date: r for r in build_dim_date(spark, date(2024, 1, 1), date(2024, 4, 1)).collect()}
    assert len(rows) == 92
    assert rows[date(2024, 1, 6)].is_weekend and rows[date(2024, 1, 7)].day_of_week == 7
    monday = rows[date(2024, 1, 1)]
    assert (monday.day_of_week, monday.is_weekend, monday.date_key) == (1, False, 20240101)
    assert rows[date(2024, 4, 1)].quarter == 2


def test_calendar_with_start_after_end_is_empty(spark):
    assert build_dim_date(spark, date(2024, 1, 2), date(2024, 1, 1)).count() == 0


def test_local_yesterday():
    assert X.local_yesterday(datetime(2024, 1, 1, 18, tzinfo=timezone.utc)) == date(2024, 1, 1)
    assert X.local_yesterday(datetime(2024, 1, 1, 16, tzinfo=timezone.utc)) == date(2023, 12, 31)
