import csv
import hashlib
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from helpers import DISTRICTS, landing, new_warehouse, rows
from pyspark.sql import functions as F
from test_jobs import scheduled_documents

from airledger.operators import snapshot as N
from airledger.operators.monitoring import SCHEDULED_RUN_TYPES
from airledger.plans.catchup import catch_up
from airledger.plans.etl import run_etl
from airledger.plans.release import bootstrap, publish, release_result
from airledger.schemas import FACT_DAILY, FACT_HOURLY, TABLE_SPECS
from airledger.sinks.release_files import (
    CURRENT,
    ReleaseStore,
    csv_digest,
    file_inventory,
    inventory_totals,
    write_csv,
)
from airledger.sources.files import read_manifest, set_digest
from airledger.sources.tables import conform, read_release_csv

JAN = date(2024, 1, 1)
FACTS = ("fact_weather_daily", "fact_weather_hourly", "fact_aqi_hourly")


def _dates(reached, **other):
    return {**{name: reached for name in FACTS}, **other}


# -- publishing range ----------------------------------------------------------------------


@pytest.mark.parametrize("behind", [1, 2, 40])
def test_range_covers_every_day_not_published_yet(behind):
    reached = date(2023, 11, 30)
    target = reached + timedelta(days=behind)
    first, last = N.publish_range(_dates(reached.isoformat()), target)
    assert last == target and (last - first).days == behind - 1


def test_nothing_to_publish_up_to_the_date_reached():
    reached = _dates("2023-12-31")
    for target in (date(2023, 12, 31), date(2023, 12, 30), date(2022, 1, 1)):
        assert N.publish_range(reached, target) is None


def test_a_repair_is_its_bounds_whatever_the_watermarks_say():
    low, high = date(2021, 2, 27), date(2021, 3, 2)
    uneven = {name: None for name in FACTS}
    assert N.publish_range(uneven, high, low, high, True) == (low, high)
    refused = {
        "has to be forced": (low, high, False),
        "needs bounds": (None, None, True),
        "both": (None, high, True),
        "not be after": (high, low, True),
    }
    for message, (start, end, force) in refused.items():
        with pytest.raises(ValueError, match=message):
            N.publish_range(uneven, high, start, end, force)


@pytest.mark.parametrize("name", FACTS)
def test_each_fact_has_a_say_in_the_watermark(name):
    assert N.manifest_watermark(_dates("2020-02-29")) == date(2020, 2, 29)
    with pytest.raises(ValueError, match="watermarks differ"):
        N.manifest_watermark(_dates("2020-02-29", **{name: "2020-03-01"}))
    with pytest.raises(ValueError, match=f"no max date for {name}"):
        N.manifest_watermark(_dates("2020-02-29", **{name: None}))


# -- retention -----------------------------------------------------------------------------

# Several releases on one day: ids differ in their time alone.
HOURLY_IDS = [f"20230404T{hour:02d}0500Z" for hour in (2, 5, 9, 14, 23)]


def _listing(spark, *ids, extra=()):
    paths = [f"s3a://bin/v1/releases/{i}/analyst/part-{n}" for i in ids for n in (0, 1)]
    return spark.createDataFrame([(p,) for p in [*paths, *extra]], "path string")


def _given_up(spark, active, keep, ids=HOURLY_IDS):
    return [r[0] for r in rows(N.deletable_releases(_listing(spark, *ids), active, keep), "*")]


def test_retention_counts_releases_of_one_day_apart(spark):
    assert _given_up(spark, HOURLY_IDS[4], 2) == HOURLY_IDS[:3]
    assert _given_up(spark, HOURLY_IDS[3], 2) == HOURLY_IDS[:2]
    assert _given_up(spark, HOURLY_IDS[4], 1) == HOURLY_IDS[:4]


def test_retention_may_keep_more_than_there_is(spark):
    assert _given_up(spark, HOURLY_IDS[4], 50) == []
    assert _given_up(spark, HOURLY_IDS[4], 5, []) == []
    with pytest.raises(ValueError, match="positive"):
        _given_up(spark, HOURLY_IDS[4], 0)


def test_retention_with_an_active_release_that_is_not_listed(spark):
    between = "20230404T100000Z"
    assert _given_up(spark, between, 2) == HOURLY_IDS[:1]
    assert _given_up(spark, "20000101T000000Z", 1) == []


def test_retention_lists_all_files_and_no_stray_ones(spark):
    stray = (
        "v1/releases/20230404T02050Z/analyst/part-0", "v2/releases/20230404T020500Z/a",
        "v1/releases/x20230404T020500Z/a", "v1/releases/20230404T020500Z/", "notes.txt",
    )
    listing = _listing(spark, *HOURLY_IDS, extra=stray)
    got = N.deletable_files(listing, HOURLY_IDS[2], 2)
    assert [r[0].rsplit("/", 3)[1:] for r in rows(got, "path")] == [
        [HOURLY_IDS[0], "analyst", f"part-{n}"] for n in (0, 1)
    ]


# -- release forms and gate ----------------------------------------------------------------


def test_reals_widen_through_their_decimal_text(spark):
    df = spark.createDataFrame([(1, 21.1)], "district_id int, temperature_2m float")
    stored = N.load_projection(df, FACT_HOURLY)
    row = N.release_form(stored, FACT_HOURLY).first()
    assert row.temperature_2m == 21.1 and row.rain is None
    assert dict(N.release_form(stored, FACT_HOURLY).dtypes)["weather_code"] == "bigint"


def test_out_of_range_small_integer_fails(spark):
    df = spark.createDataFrame([(40_000,)], "weather_code int")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        N.load_projection(df, FACT_DAILY).collect()


def _stats(spark, reached="2024-01-02", **change):
    table = {
        s.name: (s.name, 5, "2024-01-01", None if s.name == "dim_district" else reached)
        for s in TABLE_SPECS
    }
    table.update(change)
    return spark.createDataFrame(
        [v for v in table.values() if v],
        "name string, row_count bigint, min_date string, max_date string",
    )


def test_gate(spark):
    def problems(stats, end=None):
        return [r.problem for r in N.release_problems(stats, end).collect()]

    assert problems(_stats(spark)) == []
    assert problems(_stats(spark), date(2024, 1, 2)) == []
    assert problems(_stats(spark), date(2024, 1, 3)) == ["requested end date not reached"]
    assert problems(_stats(spark, dim_date=None)) == ["table set differs from the expected one"]
    extra = _stats(spark, other=("other", 1, None, None))
    assert problems(extra) == ["table set differs from the expected one"]
    assert problems(_stats(spark, dim_hour=("dim_hour", 0, None, None))) == ["table is empty"]
    lag = _stats(spark, fact_aqi_hourly=("fact_aqi_hourly", 5, None, "2024-01-01"))
    assert problems(lag) == ["fact max dates differ"]
    undated = _stats(spark, fact_aqi_hourly=("fact_aqi_hourly", 5, None, None))
    assert problems(undated) == ["fact max dates differ"]


# -- whole releases ------------------------------------------------------------------------


def _load(spark, wh, *dates, value=10.0):
    documents = landing(spark, *scheduled_documents(*dates, value=value))
    for run_type in SCHEDULED_RUN_TYPES:
        run_etl(wh, documents, run_type, start=min(dates), end=max(dates))


def _moment(day):
    return datetime(2024, 2, day, 6, 17, tzinfo=timezone.utc)


def _table(spark, store, manifest, spec):
    return store.snapshot(manifest, spec).select(*spec.columns)


def test_release_life_cycle(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh", JAN, date(2024, 1, 31))
    store = ReleaseStore(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError, match="bootstrap"):
        publish(wh, store, "test")
    _load(spark, wh, JAN)
    first = bootstrap(wh, store, "test", now=_moment(1))
    assert store.read_latest() == (
        {
            "schema_version": 1,
            "release_id": "20240201T061700Z",
            "manifest_key": "v1/releases/20240201T061700Z/manifest.json",
            "published_at_utc": "2024-02-01T06:17:00+00:00",
            "published_at_vietnam": "2024-02-01T13:17:00+07:00",
        },
        first,
    )
    hourly = first["tables"]["fact_weather_hourly"]
    assert (hourly["row_count"], hourly["min_date"], hourly["max_date"]) == (
        72, "2024-01-01", "2024-01-01",
    )
    assert first["tables"]["dim_district"]["max_date"] is None

    # The manifest can be read as a table, and single-file digests are plain SHA-256.
    listed = read_manifest(spark, store.at(store.read_latest()[0]["manifest_key"]))
    assert {r.name for r in N.release_summary(listed).collect()} == {s.name for s in TABLE_SPECS}
    parts = list(Path(store.at(hourly["csv_key"])).glob("month_key=202401/part-*"))
    if len(parts) == 1:
        assert hashlib.sha256(parts[0].read_bytes()).hexdigest() == hourly["csv_sha256"]

    # CSV and Parquet hold the same rows, header first, in key order.
    stored = _table(spark, store, first, FACT_DAILY)
    text = read_release_csv(spark, store.at(f"{CURRENT}/fact_weather_daily.csv"), FACT_DAILY)
    assert rows(text, *FACT_DAILY.columns) == rows(stored, *FACT_DAILY.columns)
    part = next(Path(store.at(f"{CURRENT}/fact_weather_daily.csv")).glob("month_key=*/part-*"))
    with part.open(encoding="utf-8") as handle:
        assert next(csv.reader(handle)) == FACT_DAILY.columns

    # Incremental: nothing to do, then one more day, then a forced repair of the first.
    assert publish(wh, store, "test", target=JAN, now=_moment(2)) is None
    with pytest.raises(ValueError, match="zero rows"):
        publish(wh, store, "test", target=date(2024, 1, 2), now=_moment(2))
    assert store.read_latest()[0]["release_id"] == "20240201T061700Z"
    _load(spark, wh, date(2024, 1, 2), value=20.0)
    second = publish(wh, store, "test", target=date(2024, 1, 2), now=_moment(3))
    daily = _table(spark, store, second, FACT_DAILY)
    assert rows(daily, "district_id", "date_key", "rain_sum") == sorted(
        (d[0], key, value + i)
        for i, d in enumerate(DISTRICTS)
        for key, value in ((20240101, 10.0), (20240102, 20.0))
    )
    _load(spark, wh, JAN, value=11.0)
    third = publish(wh, store, "test", start=JAN, end=JAN, force=True, now=_moment(4))
    repaired = _table(spark, store, third, FACT_HOURLY).groupBy("temperature_2m").count()
    assert rows(repaired, "*") == [
        (11.0, 24), (12.0, 24), (13.0, 24), (20.0, 24), (21.0, 24), (22.0, 24),
    ]
    store.verify(third)
    assert release_result("published", third)["tables"]["fact_weather_daily"]["rows"] == 6

    # A tampered alias and a tampered release file are both noticed.
    alias = next(Path(store.at(f"{CURRENT}/dim_district.csv")).glob("part-*"))
    kept = alias.read_bytes()
    alias.write_bytes(kept.replace(b"North", b"Sorth"))
    checksum = alias.parent / f".{alias.name}.crc"
    kept_crc = checksum.read_bytes()
    checksum.unlink()
    with pytest.raises(RuntimeError, match="copy of dim_district is not the released one"):
        store.verify(third)
    alias.write_bytes(kept)
    checksum.write_bytes(kept_crc)
    store.verify(third)
    next(Path(store.at(third["tables"]["dim_date"]["csv_key"])).glob("part-*")).unlink()
    with pytest.raises(ValueError, match="differ from their recorded checksums"):
        store.verify(third)


def test_a_release_writes_the_months_it_touches(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh", JAN, date(2024, 3, 31))
    store = ReleaseStore(spark, str(tmp_path / "store"))
    _load(spark, wh, JAN, date(2024, 2, 3))
    first = bootstrap(wh, store, "test", now=_moment(1))
    _load(spark, wh, date(2024, 2, 4), value=20.0)
    second = publish(wh, store, "test", target=date(2024, 2, 4), now=_moment(2))
    one, two = first["release_id"], second["release_id"]
    for name in FACTS:
        held = second["tables"][name]["months"]
        assert {m: part["release_id"] for m, part in held.items()} == {"202401": one, "202402": two}
        for suffix in ("parquet", "csv"):
            folder = Path(store.at(second["tables"][name][f"{suffix}_key"]))
            assert [p.name for p in folder.glob("month_key=*")] == ["month_key=202402"]
    assert second["tables"]["fact_weather_daily"]["row_count"] == 9
    daily = _table(spark, store, second, FACT_DAILY)
    assert rows(daily.groupBy("date_key").count(), "*") == [(20240101, 3), (20240203, 3), (20240204, 3)]
    text = read_release_csv(spark, store.at(f"{CURRENT}/fact_weather_daily.csv"), FACT_DAILY)
    assert rows(text, *FACT_DAILY.columns) == rows(daily, *FACT_DAILY.columns)
    store.verify(second)
    january = store.snapshot(second, FACT_DAILY, ["202401"])
    assert all(f"/{one}/" in f for f in january.inputFiles())

    # A release beyond retention keeps the months that others refer to, and nothing else.
    assert store.prune(two, keep=1) == [one]
    left = tmp_path / f"store/v1/releases/{one}"
    assert {p.name for p in left.iterdir()} == {"analyst", "inventory"}
    assert {p.name for p in (left / "analyst").iterdir()} == {f"{n}.{s}" for n in FACTS for s in ("csv", "parquet")}
    assert {p.name for p in left.glob("analyst/*/month_key=*")} == {"month_key=202401"}
    store.verify(second)
    assert store.snapshot(second, FACT_HOURLY).count() == 3 * 72
    folder = left / "analyst/fact_weather_daily.csv/month_key=202401"
    part = next(folder.glob("part-*"))
    part.unlink()
    (folder / f".{part.name}.crc").unlink()
    (folder / "part-strange.csv").write_text("x")
    found = rows(store.findings(second), "name", "format", "problem")
    assert found == [("fact_weather_daily", "csv", "missing"), ("fact_weather_daily", "csv", "unexpected")]


def test_a_refused_activation_leaves_the_current_copies(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh", JAN, date(2024, 1, 31))
    store = ReleaseStore(spark, str(tmp_path / "store"))
    _load(spark, wh, JAN)
    manifest = bootstrap(wh, store, "test", now=_moment(1))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "store/v1/current").rglob("*")}
    other = {**manifest, "release_id": "20240209T000000Z"}
    with pytest.raises(RuntimeError, match="another release"):
        store.activate(other, _moment(2), replaces=None)
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "store/v1/current").rglob("*")}
    store.verify(manifest)


def test_csv_parts_are_in_key_order(spark, tmp_path):
    table = spark.range(0, 5000, 1, 8).select(
        (F.col("id") * 7919 % 5000).cast("int").alias("district_id"), F.lit(20240101).alias("date_key")
    )
    stored = conform(table, FACT_DAILY.released)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        write_csv(stored, FACT_DAILY, str(tmp_path / "csv"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    ids = []
    for part in sorted((tmp_path / "csv").glob("part-*")):
        with part.open(encoding="utf-8") as handle:
            ids += [int(r["district_id"]) for r in csv.DictReader(handle)]
    assert ids == list(range(5000))


def test_old_releases_are_pruned_after_activation(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh", JAN, date(2024, 1, 31))
    store = ReleaseStore(spark, str(tmp_path / "store"))
    _load(spark, wh, JAN)
    for day in (20, 21):
        old = tmp_path / f"store/v1/releases/202401{day}T000000Z"
        old.mkdir(parents=True)
        (old / "manifest.json").write_text("{}")
    bootstrap(wh, store, "test", now=_moment(1))
    catch_up_documents = landing(spark, *scheduled_documents(JAN, value=5.0))
    results, manifest = catch_up(wh, catch_up_documents, JAN, JAN, store=store)
    assert [r.rows_loaded for r in results] == [3, 72, 72]
    left = sorted(p.name for p in (tmp_path / "store/v1/releases").iterdir())
    assert left == ["20240121T000000Z", "20240201T061700Z", manifest["release_id"]]


def test_pointer_moves_only_from_the_expected_release(spark, tmp_path):
    wh = new_warehouse(spark, tmp_path / "wh", JAN, date(2024, 1, 31))
    store = ReleaseStore(spark, str(tmp_path / "store"))
    _load(spark, wh, JAN)
    manifest = bootstrap(wh, store, "test", now=_moment(1))
    with pytest.raises(RuntimeError, match="another release"):
        store.activate(manifest, _moment(2), replaces=None)


def test_digest_does_not_depend_on_file_order_or_number(spark, tmp_path):
    folder = tmp_path / "analyst/dim_date.csv"
    folder.mkdir(parents=True)
    for name, body in (("part-1", b"a"), ("part-2", b"b")):
        (folder / name).write_bytes(body)
    total = inventory_totals(file_inventory(spark, str(tmp_path / "analyst"))).first()
    one, two = hashlib.sha256(b"a").hexdigest(), hashlib.sha256(b"b").hexdigest()
    added = [(int(one[i : i + 8], 16) + int(two[i : i + 8], 16)) % 2**32 for i in range(0, 64, 8)]
    assert (total.name, total.format, total.bytes) == ("dim_date", "csv", 2)
    assert total.sha256 == "".join(f"{word:08x}" for word in added)


def test_equal_files_do_not_cancel_out(spark):
    same = hashlib.sha256(b"x").hexdigest()
    digests = [
        spark.createDataFrame([(same,)] * n, "s string").agg(set_digest(F.col("s"))).first()[0]
        for n in (1, 2, 3)
    ]
    assert digests[0] == same and len(set(digests)) == 3


def test_copies_may_be_cut_into_other_files(spark, tmp_path):
    table = spark.range(0, 3000, 1, 6).select(
        (F.col("id") % 7).cast("int").alias("district_id"),
        F.col("id").cast("int").alias("date_key"),
    )
    table = conform(table, FACT_DAILY.released)
    for name, rows_ in (
        ("six", table), ("one", table.coalesce(1)),
        ("changed", table.withColumn("date_key", F.greatest("date_key", F.lit(1)))),
        ("twice", table.unionByName(table.where("date_key = 5"))),
    ):
        write_csv(rows_, FACT_DAILY, str(tmp_path / name))
    six, one, changed, twice = (
        csv_digest(spark, str(tmp_path / name), FACT_DAILY)
        for name in ("six", "one", "changed", "twice")
    )
    assert six == one and six[0] == 3000
    assert changed != six and twice != six
