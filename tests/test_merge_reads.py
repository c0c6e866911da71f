from datetime import date, datetime, timedelta, timezone

import pytest
from helpers import district_frame, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.operators import districts as O
from airledger.operators import hours as H
from airledger.operators import merge as G
from airledger.operators import reads as R
from airledger.operators.sync import local_marks, sync_delta, watermarks
from airledger.schemas import DIM_HOUR, FACT_DAILY, FACT_HOURLY, SPECS, released_type
from airledger.sources.tables import conform

D = date(2024, 1, 1)


# (district, day of May 2022, rain, weather code)
STORED = [(4, 9, 1.5, 61), (4, 10, 0.0, 3), (8, 9, 7.25, None)]
ARRIVED = [(4, 10, None, 80), (8, 10, 2.5, 63), (5, 9, 0.5, 51)]


def _observed(spark, values, *, columns=("rain_sum", "weather_code")):
    """Daily fact rows; columns not asked for are absent."""
    df = spark.createDataFrame(
        [(n, 20220500 + day, date(2022, 5, day), rain, code) for n, day, rain, code in values],
        "district_id int, date_key int, observed_date date, rain_sum float, weather_code smallint",
    )
    return df.select("district_id", "date_key", "observed_date", *columns)


def _stored(spark, values):
    return conform(_observed(spark, values), FACT_DAILY.stored)


def _shown(df):
    shown = df.select("district_id", F.dayofmonth("observed_date"), "rain_sum", "weather_code")
    return sorted((tuple(r) for r in shown.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("merge", [G.fold_delta, G.replace_delta])
def test_rows_that_arrive_take_the_place_of_stored_ones(spark, merge):
    delta = _observed(spark, ARRIVED)
    once = merge(_stored(spark, STORED), delta, FACT_DAILY)
    assert _shown(once) == [
        (4, 9, 1.5, 61), (4, 10, None, 80), (5, 9, 0.5, 51), (8, 9, 7.25, None), (8, 10, 2.5, 63),
    ]
    assert _shown(merge(conform(once, FACT_DAILY.stored), delta, FACT_DAILY)) == _shown(once)


def test_the_first_delta_is_the_table(spark):
    first = G.fold_delta(None, _observed(spark, ARRIVED), FACT_DAILY)
    assert _shown(first) == sorted(ARRIVED)


def test_fold_leaves_one_row_of_a_key_stored_twice(spark):
    current = _stored(spark, [*STORED, (4, 9, 9.0, 95), (8, 9, 3.0, 61)])
    got = _shown(G.fold_delta(current, _observed(spark, [(8, 9, 4.75, 2)]), FACT_DAILY))
    assert [r[:2] for r in got] == [(4, 9), (4, 10), (8, 9)]
    assert got[0] in [(4, 9, 1.5, 61), (4, 9, 9.0, 95)] and got[2] == (8, 9, 4.75, 2)


@pytest.mark.parametrize("merge", [G.fold_delta, G.replace_delta])
@pytest.mark.parametrize("keep_absent", [False, True])
def test_measures_a_delta_lacks(spark, merge, keep_absent):
    delta = _observed(spark, ARRIVED[:2], columns=("weather_code",))
    got = _shown(merge(_stored(spark, STORED), delta, FACT_DAILY, keep_absent=keep_absent))
    assert got == [
        (4, 9, 1.5, 61), (4, 10, 0.0 if keep_absent else None, 80), (8, 9, 7.25, None),
        (8, 10, None, 63),
    ]


def test_columns_outside_the_table_are_refused(spark):
    delta = _observed(spark, ARRIVED).withColumns({"snow": F.lit(1), "fog": F.lit(2)})
    with pytest.raises(ValueError, match="unknown columns for fact_weather_daily.*fog.*snow"):
        G.fold_delta(_stored(spark, STORED), delta, FACT_DAILY)


def test_latest_per_key_keeps_whole_rows(spark):
    df = spark.createDataFrame(
        [(1, 10, 5.0, None), (1, 11, None, 2), (2, 3, 1.0, 1)], "k int, o long, a double, b int"
    )
    assert rows(G.latest_per_key(df, ["k"], "o"), "k", "a", "b", "o") == [
        (1, None, 2, 11), (2, 1.0, 1, 3),
    ]


def test_latest_per_key_combines_before_the_shuffle(spark):
    df = spark.range(100).select(
        (F.col("id") % 3).alias("k"), "id", (F.col("id") * 2).alias("v")
    )
    plan = G.latest_per_key(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "HashAggregate" in plan and "SortAggregate" not in plan


def test_conform_fills_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "district_id int, hour_key int")
    got = conform(df, FACT_HOURLY.released)
    assert got.columns == FACT_HOURLY.columns
    assert got.first().wind_direction_10m is None


def test_released_types():
    assert FACT_DAILY.released["weather_code"].dataType == T.LongType()
    assert FACT_DAILY.released["rain_sum"].dataType == T.DoubleType()
    with pytest.raises(TypeError):
        released_type(T.BinaryType())


# -- hours ---------------------------------------------------------------------------------


def _instants(spark, *hours):
    base = datetime(2024, 1, 31, 17, tzinfo=timezone.utc)
    return spark.createDataFrame([(base + timedelta(hours=h),) for h in hours], "observed_at timestamp")


def test_hour_keys_follow_insertion_order(spark):
    first = H.assign_hour_keys(
        H.distinct_hours(_instants(spark, 5, 3, 3)), spark.createDataFrame([], DIM_HOUR.stored)
    )
    assert [r.hour_key for r in first.orderBy("observed_at").collect()] == [1, 2]
    both = H.refresh_hours(first, H.distinct_hours(_instants(spark, -9, -800, 3, 7)))
    got = [r.hour_key for r in both.orderBy("observed_at").collect()]
    assert got == [3, 4, 1, 2, 5]


def test_hours_carry_local_dates(spark):
    row = H.distinct_hours(_instants(spark, 0)).first()
    assert (row.date_key, row.observed_date) == (20240201, date(2024, 2, 1))


def test_hours_come_from_all_facts(spark):
    hours = H.distinct_hours(_instants(spark, 1), _instants(spark, 1, 2))
    assert hours.count() == 2


# -- districts -----------------------------------------------------------------------------


def test_select_districts(spark):
    known = district_frame(spark)
    assert rows(O.select_districts(known, [3, 1, 3]), "district_id") == [(1,), (3,)]
    assert rows(O.select_districts(known, None, 2), "district_id") == [(1,), (2,)]
    with pytest.raises(ValueError, match="unknown district ids.*8.*9"):
        O.select_districts(known, [9, 1, 8])
    with pytest.raises(ValueError, match="greater than 0"):
        O.select_districts(known, None, 0)


def test_district_lookup(spark):
    known = district_frame(spark)
    assert O.district_by_id(known, 2).first().district_name == "South"
    assert O.district_by_name(known, "East").first().district_id == 3
    assert O.district_by_id(known, 99).count() == 0


# -- reads ---------------------------------------------------------------------------------


def _hours(spark, count=48):
    base = datetime(2024, 1, 1, 17, tzinfo=timezone.utc)
    instants = spark.createDataFrame(
        [(base + timedelta(hours=h),) for h in range(count)], "observed_at timestamp"
    )
    return H.assign_hour_keys(
        H.distinct_hours(instants), spark.createDataFrame([], DIM_HOUR.stored)
    )


def _hourly(spark, dim):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "district_id int")
    return conform(dim.select("hour_key").join(ids, how="inner", on=F.lit(True)), FACT_HOURLY.stored)


def test_pages(spark):
    dim = _hours(spark)
    fact = _hourly(spark, dim)
    assert R.hourly_range(fact, dim).count() == 100
    page = R.hourly_range(fact, dim, None, date(2024, 1, 3), date(2024, 1, 3), 5, 2).collect()
    assert [(r.hour_key, r.district_id) for r in page] == [
        (25, 3), (26, 1), (26, 2), (26, 3), (27, 1),
    ]
    for limit in (0, 1001):
        with pytest.raises(ValueError):
            R.hourly_range(fact, dim, limit=limit)
    with pytest.raises(ValueError):
        R.hourly_range(fact, dim, offset=-1)


@pytest.mark.parametrize("limit, offset", [(10, 0), (7, 5), (100, 71), (50, 140), (5, 500)])
def test_deep_page_equals_ordinary_page(spark, limit, offset):
    dim = _hours(spark)
    fact = _hourly(spark, dim)
    plain = R.hourly_range(fact, dim, limit=limit, offset=offset)
    deep = R.hourly_range(fact, dim, limit=limit, offset=offset, by_counts=True)
    keys = ["hour_key", "district_id"]
    assert deep.select(*keys).collect() == plain.select(*keys).collect()


def test_daily_filters_are_optional_and_inclusive(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, d), float(d), float(d), float(d), 1.5) for d in range(1, 6)]
        + [(2, date(2024, 1, 3), None, None, None, None)],
        "district_id int, observed_date date, temperature_2m_mean double, "
        "temperature_2m_max double, temperature_2m_min double, precipitation_sum double",
    )
    got = R.daily_range(df, None, date(2024, 1, 3), date(2024, 1, 4)).collect()
    assert [(r.district_id, r.observed_date.day) for r in got] == [(1, 3), (2, 3), (1, 4)]
    assert R.daily_range(df).count() == 6
    row = R.daily_statistics(df, 1, None, date(2024, 1, 4)).first()
    assert (row.district_id, row.start_date, row.end_date) == (1, None, date(2024, 1, 4))
    assert tuple(row)[3:] == (2.5, 4.0, 1.0, 6.0)
    assert tuple(R.daily_statistics(df, 9).first())[3:] == (None, None, None, None)


def test_export_window_guards(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 2.0)], SPECS["dim_district"].stored)
    spec = SPECS["dim_district"]
    assert R.export_window(df, spec).count() == 1
    with pytest.raises(ValueError, match="together"):
        R.export_window(df, spec, D)
    with pytest.raises(ValueError, match="does not support date filtering"):
        R.export_window(df, spec, D, D)


# -- sync ----------------------------------------------------------------------------------


def test_sync_delta_uses_mark_or_cutoff(spark):
    source = spark.createDataFrame(
        [(i, k, date(2024, 1, k)) for i in (1, 2, 3, 4) for k in (1, 2, 3)],
        "district_id int, date_key int, observed_date date",
    )
    target = source.where("(district_id = 1 and date_key <= 2) or (district_id = 2)")
    local = spark.createDataFrame([(1,), (2,), (3,)], "district_id int")
    marks = watermarks(target, FACT_DAILY)
    assert rows(marks, "district_id", "last_key") == [(1, 2), (2, 3)]

    def keys(cutoff, **more):
        known = more.pop("marks", local_marks(local, marks))
        got = sync_delta(source, FACT_DAILY, known, cutoff, **more)
        return rows(got, "district_id", "date_key")

    late = datetime(2025, 1, 1, tzinfo=timezone.utc)
    # District 3 is known but empty (mark -1); district 4 is unknown to the target.
    assert keys(late) == [(1, 3), (3, 1), (3, 2), (3, 3)]
    # The cutoff compares by UTC date and admits the unknown district as well.
    edge = datetime(2024, 1, 3, 23, 59, tzinfo=timezone(timedelta(hours=7)))
    assert keys(edge) == [(1, 3), (2, 3), (3, 1), (3, 2), (3, 3), (4, 3)]
    assert len(keys(late, full=True)) == 12
    assert len(keys(late, marks=None)) == 12
    with pytest.raises(ValueError, match="time zone"):
        keys(datetime(2024, 1, 1))
