"""Digests by which released rows and copies of them are compared."""

from datetime import date

import pytest
from helpers import days
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.schemas import FACT_DAILY
from airledger.sinks.release_files import ReleaseStore, row_digest, write_csv
from airledger.sources.tables import conform

JAN = date(2024, 1, 1)


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


def test_a_digest_tells_nulls_zeros_and_places_apart_without_writing_json(spark):
    rows = [(None, "a", 0.0), ("a", None, 0.0), ("", "a", 0.0), ("a", None, -0.0), ("a", None, None)]
    schema = "one string, two string, three double"
    frames = [spark.createDataFrame([row], schema) for row in rows]
    assert len({tuple(row_digest(f).first()) for f in frames}) == len(rows)
    plan = row_digest(frames[0])._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan


def test_a_copy_is_compared_with_the_released_rows_in_one_reading(spark, tmp_path, monkeypatch):
    month = T.StructField("month_key", T.IntegerType())
    schema = T.StructType([*FACT_DAILY.released.fields, month])
    table = conform(_facts(spark, days(JAN, 3) + days(date(2024, 2, 1), 3), (1, 2)), schema)
    store = ReleaseStore(spark, str(tmp_path))
    months = {m: {"release_id": "r"} for m in ("202401", "202402")}
    manifest = {"release_id": "r", "tables": {FACT_DAILY.name: {"months": months}}}
    write_csv(table, FACT_DAILY, store.at(f"v1/releases/r/analyst/{FACT_DAILY.name}.csv"))
    write_csv(table, FACT_DAILY, str(tmp_path / "same"))
    write_csv(table.where("date_key <> 20240202"), FACT_DAILY, str(tmp_path / "short"))
    write_csv(
        table.unionByName(table.where("date_key = 20240202")), FACT_DAILY, str(tmp_path / "twice")
    )
    reads = []
    of_release = store._csv_rows
    monkeypatch.setattr(store, "_csv_rows", lambda *a: of_release(*a).where(_seen(reads)))
    store._require_same(manifest, FACT_DAILY, str(tmp_path / "same"), list(months))
    assert len(reads) == 1
    for other in ("short", "twice"):
        with pytest.raises(RuntimeError, match="not the released one"):
            store._require_same(manifest, FACT_DAILY, str(tmp_path / other), list(months))


def _seen(reads):
    reads.append(1)
    return F.lit(True)
