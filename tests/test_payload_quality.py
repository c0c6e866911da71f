import json
from datetime import date, timedelta

import pytest
from helpers import daily_body, days, hourly_body, landing, rows
from pyspark.sql import functions as F

from airledger.functions.rules import DAILY_RULES, RangeRule
from airledger.operators import payload as P
from airledger.operators import quality as Q
from airledger.operators.ordering import with_ordinal
from airledger.schemas import AQI_MEASURES
from airledger.session import staging
from airledger.sources.landing import read_landing_files

JAN1 = date(2024, 1, 1)
FEED = "archive-daily"


def _doc(body, ids=(1,), name="d"):
    return (name, FEED, list(ids), JAN1, JAN1, body)


def test_time_array_decides_the_number_of_rows(spark):
    body = daily_body(
        days(JAN1, 3),
        temperature_2m_mean=[20.5, None],
        temperature_2m_max=[1, 2, 3, 4, 5],
        weather_code=[61.9, 3, -1.5],
    )
    got = P.parse_payloads(landing(spark, _doc(body)), P.DAILY)
    assert rows(
        got, "date_key", "temperature_2m_mean", "temperature_2m_max", "weather_code", "rain_sum"
    ) == [
        (20240101, 20.5, 1.0, 61, None),
        (20240102, None, 2.0, 3, None),
        (20240103, None, 3.0, -1, None),
    ]


def test_quoted_numbers_do_not_null_their_neighbours(spark):
    body = daily_body(days(JAN1, 2), rain_sum=["1.5", 2])
    got = P.parse_payloads(landing(spark, _doc(body)), P.DAILY)
    assert rows(got, "rain_sum") == [(1.5,), (2.0,)]


@pytest.mark.parametrize("body", [{}, {"daily": {}}, {"daily": None}, {"hourly": {"time": ["x"]}}])
def test_missing_section_gives_no_rows(spark, body):
    documents = landing(spark, _doc(body))
    assert P.parse_payloads(documents, P.DAILY).count() == 0
    assert P.document_problems(documents, P.DAILY).count() == 0


def test_batch_elements_follow_the_district_order(spark):
    bodies = [daily_body([JAN1], rain_sum=[float(i)]) for i in range(3)]
    got = P.parse_payloads(landing(spark, _doc(bodies, ids=(30, 10, 20))), P.DAILY)
    assert rows(got, "district_id", "rain_sum") == [(10, 1.0), (20, 2.0), (30, 0.0)]


def test_count_mismatch_and_bad_json_are_reported_per_district(spark):
    one = daily_body([JAN1], rain_sum=[1.0])
    documents = landing(
        spark,
        _doc([one], ids=(1, 2), name="short"),
        _doc(json.dumps(one)[:-2], ids=(3,), name="cut"),
        _doc(one, ids=(4,), name="fine"),
    )
    assert rows(P.parse_payloads(documents, P.DAILY), "district_id") == [(4,)]
    assert rows(P.document_problems(documents, P.DAILY), "doc_id", "district_id", "problem") == [
        ("cut", 3, "document is not valid JSON"),
        ("short", 1, "document holds 1 payloads for 2 districts"),
        ("short", 2, "document holds 1 payloads for 2 districts"),
    ]


def test_hourly_times_are_local(spark):
    body = hourly_body(["2024-01-01T00:00", "2023-12-31T17:00Z"], pm10=[1, 2], methane=[3])
    got = P.parse_payloads(landing(spark, _doc(body)), P.AQI)
    utc = F.convert_timezone(None, F.lit("UTC"), "observed_at").cast("string")
    assert rows(got, utc, "date_key", "month_key", "pm10", "methane") == [
        ("2023-12-31 17:00:00", 20240101, 202401, 1.0, 3.0),
        ("2023-12-31 17:00:00", 20240101, 202401, 2.0, None),
    ]
    assert set(AQI_MEASURES) <= set(got.columns)


@pytest.mark.parametrize("odd", ["2024-1-1", None, "2023-02-29", "soon", ""])
def test_a_malformed_day_spoils_its_element_only(spark, odd):
    good = daily_body(days(JAN1, 2), rain_sum=[1.0, 2.0])
    bad = {"daily": {"time": ["2024-01-01", odd, "also bad"], "rain_sum": [7.0, 8.0, 9.0]}}
    documents = landing(spark, _doc([good, bad], ids=(1, 2)), _doc(good, ids=(3,), name="other"))
    assert rows(P.parse_payloads(documents, P.DAILY), "district_id", "rain_sum") == [
        (1, 1.0), (1, 2.0), (3, 1.0), (3, 2.0),
    ]
    parsed = P.unpivot(P.unpack_documents(documents, P.DAILY), P.DAILY)
    shown = "null" if odd is None else odd
    assert rows(P.element_problems(parsed), "district_id", "doc_id", "problem") == [
        (2, "d", f"malformed date: {shown}"),
    ]


def test_long_series_stays_linear(spark):
    """A document of several years of hours unpivots without copying its arrays per row."""
    times = [f"2024-01-01T00:{i % 60:02d}" for i in range(40_000)]
    body = hourly_body(times, **{m: list(range(40_000)) for m in AQI_MEASURES})
    got = P.parse_payloads(landing(spark, _doc(body)), P.AQI)
    total = got.agg(F.count("*").alias("n"), F.sum("pm10").alias("s")).first()
    assert (total.n, total.s) == (40_000, sum(range(40_000)))


def test_landing_files(spark, tmp_path):
    folder = tmp_path / "feed=archive-daily/start_date=2024-01-01/end_date=2024-01-02"
    folder = folder / "district_ids=7-9"
    folder.mkdir(parents=True)
    bodies = [daily_body(days(JAN1, 2), rain_sum=[i, i + 1]) for i in (1, 5)]
    (folder / "one.json").write_text(json.dumps(bodies, indent=1))
    documents = read_landing_files(spark, str(tmp_path))
    row = documents.first()
    assert (row.feed, row.district_ids, row.end_date) == (FEED, [7, 9], date(2024, 1, 2))
    got = P.parse_payloads(documents, P.DAILY)
    assert rows(got, "district_id", "rain_sum") == [(7, 1.0), (7, 2.0), (9, 5.0), (9, 6.0)]


def _preferred(spark, tmp_path, *documents):
    with staging(spark, "test") as stage:
        parsed = P.with_keys(P.unpivot(P.unpack_documents(landing(spark, *documents), P.DAILY), P.DAILY), P.DAILY)
        ranked = with_ordinal(stage, P.usable_documents(parsed), P.preference(), "documents")
        return rows(P.preferred_rows(parsed, ranked, P.DAILY), "district_id", "date_key", "rain_sum")


def test_documents_are_chosen_per_district_and_day(spark, tmp_path):
    """Batch before single, then fewer days, then the later end; what one lacks comes from the
    next, and documents with a problem don't count."""
    three = days(JAN1, 3)

    def doc(name, ids, first, count, *values):
        bodies = [daily_body(days(first, count), rain_sum=[v] * count) for v in values]
        return (name, FEED, list(ids), first, first + timedelta(days=count - 1), bodies if len(ids) > 1 else bodies[0])

    spoilt = ("spoilt", FEED, [1, 9], JAN1, JAN1, [{"daily": {"time": ["x"]}}, {"daily": {"time": ["x"]}}])
    got = _preferred(
        spark, tmp_path, doc("wide", (1,), JAN1, 3, 1.0), doc("narrow", (1,), three[1], 1, 2.0),
        doc("late", (2,), three[1], 2, 3.0), doc("early", (2,), JAN1, 2, 4.0),
        doc("batch", (2, 3), JAN1, 1, 5.0, 6.0), doc("alone", (3,), JAN1, 2, 7.0), spoilt,
    )
    assert got == [
        (1, 20240101, 1.0), (1, 20240102, 2.0), (1, 20240103, 1.0),
        (2, 20240101, 5.0), (2, 20240102, 3.0), (2, 20240103, 3.0),
        (3, 20240101, 6.0), (3, 20240102, 7.0),
    ]


def test_of_a_time_that_a_document_repeats_the_last_row_counts(spark, tmp_path):
    body = daily_body([JAN1, JAN1, date(2024, 1, 2), JAN1], rain_sum=[1.0, 2.0, 3.0, 4.0])
    assert _preferred(spark, tmp_path, _doc(body)) == [(1, 20240101, 4.0), (1, 20240102, 3.0)]


# -- range rules ---------------------------------------------------------------------------


def _measured(spark, *values):
    schema = "district_id int, latitude double, longitude double, temperature_2m_mean double"
    return spark.createDataFrame([(i, *v) for i, v in enumerate(values)], schema)


def test_each_violated_field_is_reported(spark):
    df = _measured(spark, (25.0, 120.0, 90.0), (21.0, 105.8, 25.0))
    errors = Q.error_rows(df, DAILY_RULES, "analyst.fact_weather_daily")
    assert rows(errors, "district_id", "field_name", "invalid_value", "reason") == [
        (0, "latitude", "25.0", "latitude must be between 20.5 and 21.5"),
        (0, "longitude", "120.0", "longitude must be between 105.2 and 106.1"),
        (0, "temperature_2m_mean", "90.0", "temperature_2m_mean must be between -5.0 and 45.0"),
    ]
    assert rows(Q.valid_rows(df, DAILY_RULES), "district_id") == [(1,)]
    assert Q.count_outcomes(df, DAILY_RULES).first().asDict() == {
        "rows_loaded": 1, "rows_skipped": 1, "total_rejected": 3,
    }


def test_bounds_are_inclusive_null_passes_and_nan_fails(spark):
    df = _measured(
        spark,
        (20.5, 105.2, -5.0), (21.5, 106.1, 45.0), (None, None, None),
        (21.0, 105.8, float("nan")), (21.0, 105.8, 45.0000001),
    )
    assert rows(Q.valid_rows(df, DAILY_RULES), "district_id") == [(0,), (1,), (2,)]
    assert rows(Q.rejected_rows(df, DAILY_RULES), "district_id") == [(3,), (4,)]


def test_valid_and_rejected_split_the_input(spark):
    df = spark.range(1000).select(
        F.col("id").cast("int").alias("district_id"),
        (F.col("id") / 10 - 20).alias("temperature_2m_mean"),
    )
    rules = [RangeRule("temperature_2m_mean", "-5.0", "45.0")]
    good, bad = Q.valid_rows(df, rules).count(), Q.rejected_rows(df, rules).count()
    assert good + bad == 1000 and good == 501


def test_counts_of_no_rows(spark):
    empty = _measured(spark).where("false")
    assert tuple(Q.count_outcomes(empty, DAILY_RULES).first()) == (0, 0, 0)


def test_duplicate_keys_and_orphans(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a int, b int")
    assert rows(Q.duplicate_keys(df, ["a", "b"]), "a", "b", "copies") == [(1, 1, 2)]
    with pytest.raises(ValueError, match="duplicate primary keys"):
        Q.require_unique(df, ["a", "b"], "t")
    parent = spark.createDataFrame([(2,)], "id int")
    assert rows(Q.orphans(df, "a", parent, "id"), "a") == [(1,)]
