"""District lookups and selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airledger.operators.quality import require_empty


def district_by_id(districts: DataFrame, district_id: int) -> DataFrame:
    return districts.where(F.col("district_id") == district_id).limit(1)


def district_by_name(districts: DataFrame, name: str) -> DataFrame:
    return districts.where(F.col("district_name") == name).limit(1)


def unknown_districts(requested: DataFrame, districts: DataFrame) -> DataFrame:
    """Requested ids the dimension does not have."""
    return (
        requested.select("district_id")
        .distinct()
        .join(districts.select("district_id"), "district_id", "left_anti")
    )


def requested_districts(
    districts: DataFrame, requested: DataFrame | None, first: int | None = None
) -> DataFrame:
    """Requested districts in id order, at most ``first`` of them; all when none are named."""
    chosen = districts
    if requested is not None:
        chosen = chosen.join(requested.select("district_id"), "district_id", "left_semi")
    if first is None:
        return chosen
    if first < 1:
        raise ValueError("the number of districts must be greater than 0")
    return chosen.orderBy("district_id").limit(first)


def select_districts(
    districts: DataFrame, ids: Sequence[int] | None = None, first: int | None = None
) -> DataFrame:
    """As ``requested_districts`` for an explicit id list; unknown ids are an error."""
    if not ids:
        return requested_districts(districts, None, first)
    spark = districts.sparkSession
    requested = spark.createDataFrame([(i,) for i in sorted(set(ids))], "district_id int")
    require_empty(
        unknown_districts(requested, districts).orderBy("district_id"),
        "unknown district ids",
        most=None,
    )
    return requested_districts(districts, requested, first)


def not_yet_loaded(districts: DataFrame, fact: DataFrame) -> DataFrame:
    """Districts without a single row in ``fact``."""
    return districts.join(fact.select("district_id").distinct(), "district_id", "left_anti")


def missing_payloads(requested: DataFrame, delivered: DataFrame) -> DataFrame:
    """Requested districts for which no usable document was found."""
    return requested.select("district_id").join(
        delivered.select("district_id").distinct(), "district_id", "left_anti"
    )
