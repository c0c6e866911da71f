"""Scans of warehouse tables, snapshots and reference files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.schemas import ANALYST, DIM_DISTRICT, TableSpec


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order; columns the input lacks become typed nulls."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def read_release_csv(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Released CSV with declared types; text is UTF-8 and its first row is a header."""
    return (
        spark.read.schema(spec.released)
        .option("header", "true")
        .option("nullValue", "")
        .option("timestampFormat", CSV_TIMESTAMP)
        .csv(path)
        .select(*spec.columns)
    )


CSV_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_districts_csv(spark: SparkSession, path: str) -> DataFrame:
    """District seed: id, name, latitude, longitude, supplied by the user as CSV."""
    return spark.read.schema(DIM_DISTRICT.stored).option("header", "true").csv(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    spec: TableSpec,
    *,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """An external relational warehouse table, read in parallel ranges of its key column."""
    table = spark.read.jdbc(
        url,
        f"{ANALYST}.{spec.name}",
        column=spec.key_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties or {},
    )
    return conform(table, spec.stored)
