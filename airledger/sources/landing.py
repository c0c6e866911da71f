"""Landed feed documents: where they lie and how they are scanned.

A landing row is ``doc_id string, feed string, district_ids array<int>, start_date date,
end_date date, body string``. ``body`` is the JSON document exactly as fetched: one object,
or an array whose i-th element belongs to the i-th district id.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LANDING_SCHEMA = (
    "doc_id string, feed string, district_ids array<int>, start_date date, end_date date, "
    "body string"
)


def read_landing_files(spark: SparkSession, root: str) -> DataFrame:
    """Raw JSON files laid out as
    ``feed=<feed>/start_date=<d>/end_date=<d>/district_ids=<id>[-<id>...]/<name>.json``.

    The folder names are partition columns, so filters on feed and dates prune the listing.
    """
    files = (
        spark.read.schema(
            "value string, feed string, start_date date, end_date date, district_ids string"
        )
        .text(root, wholetext=True)
    )
    return files.select(
        F.col("_metadata.file_path").alias("doc_id"),
        "feed",
        F.split("district_ids", "-").cast("array<int>").alias("district_ids"),
        "start_date",
        "end_date",
        F.col("value").alias("body"),
    )


def read_landing_table(spark: SparkSession, path: str) -> DataFrame:
    """Landing rows kept as Parquet, many documents per file."""
    return spark.read.schema(LANDING_SCHEMA).parquet(path)


def documents_between(landing: DataFrame, feed: str, start: date, end: date) -> DataFrame:
    """Archive documents that overlap the run's date range; their rows outside it aren't loaded."""
    return landing.where(
        (F.col("feed") == feed)
        & (F.col("end_date") >= F.lit(start))
        & (F.col("start_date") <= F.lit(end))
    )


def forecast_documents(landing: DataFrame, feed: str) -> DataFrame:
    """Forecast documents; a run reads them whatever its date range is."""
    return landing.where(F.col("feed") == feed)
