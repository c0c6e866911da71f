"""Release statistics, gates, publishing ranges and retention."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.functions.measures import widen
from airledger.functions.paths import release_id, table_folder, table_part
from airledger.operators.merge import PARTITION_COLUMN, fold_delta, replace_delta
from airledger.schemas import FACT_SPECS, TABLE_SPECS, TableSpec
from airledger.sources.tables import conform

KEPT_RELEASES = 3
REFERENCE_SCHEMA = "release_id string, name string, month string"


def load_projection(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Validated rows in warehouse columns and types; everything else is dropped, except
    the partition column of a partitioned table.

    Narrowing happens here, after validation has seen full doubles.
    """
    target = spec.stored
    if spec.partitioned and PARTITION_COLUMN in rows.columns:
        target = T.StructType([*target.fields, T.StructField(PARTITION_COLUMN, T.IntegerType())])
    return conform(rows, target)


def release_form(table: DataFrame, spec: TableSpec) -> DataFrame:
    """Warehouse rows in released types, with the partition column where they have it."""
    return table.select(
        *[
            widen(F.col(f.name), f.dataType, spec.released[f.name].dataType).alias(f.name)
            for f in spec.stored
        ],
        *[c for c in table.columns if c == PARTITION_COLUMN],
    )


def merge_snapshot(
    current: DataFrame | None,
    delta: DataFrame,
    spec: TableSpec,
    *,
    current_unique: bool = False,
) -> DataFrame:
    """Next snapshot of a table. Deletions are never inferred; repeating a merge is harmless.

    ``current_unique`` promises that the current snapshot has no repeated keys, as every
    snapshot merged here has; it is then not shuffled to find out.
    """
    if current is not None and current_unique:
        merged = replace_delta(current, delta, spec, schema=spec.released)
        return merged.select(*spec.columns, *[c for c in merged.columns if c == PARTITION_COLUMN])
    return fold_delta(current, delta, spec, schema=spec.released)


def table_stats(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Row count and date range as text; tables without a date column have no range."""
    if spec.date_column is None:
        low = high = F.lit(None).cast("string")
    else:
        low = F.min(spec.date_column).cast("string")
        high = F.max(spec.date_column).cast("string")
    return df.agg(
        F.lit(spec.name).alias("name"),
        F.count(F.lit(1)).alias("row_count"),
        low.alias("min_date"),
        high.alias("max_date"),
    )


def month_stats(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Row count and date range as text by month; hourly facts have no date of their own."""
    dates = [
        F.lit(None).cast("string").alias(name)
        if spec.date_column is None
        else bound(spec.date_column).cast("string").alias(name)
        for name, bound in (("min_date", F.min), ("max_date", F.max))
    ]
    return df.groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("row_count"), *dates)


def hour_range_from_dimension(stats: DataFrame) -> DataFrame:
    """Hourly facts have no date of their own: they take the hour dimension's range."""
    via_hour = [s.name for s in TABLE_SPECS if s.date_via_hour]
    hours = stats.where(F.col("name") == "dim_hour")
    low = hours.select(F.max("min_date")).scalar()
    high = hours.select(F.max("max_date")).scalar()
    borrowed = F.col("name").isin(via_hour)
    return stats.withColumns(
        {
            "min_date": F.when(borrowed, low).otherwise(F.col("min_date")),
            "max_date": F.when(borrowed, high).otherwise(F.col("max_date")),
        }
    )


def release_problems(stats: DataFrame, expected_end: date | None = None) -> DataFrame:
    """Every reason why a set of table statistics must not be published, one per row."""
    spark = stats.sparkSession
    names = [s.name for s in TABLE_SPECS]
    facts = [s.name for s in FACT_SPECS]
    expected = spark.createDataFrame([(n,) for n in names], "expected string")
    complete = expected.join(stats, expected.expected == stats.name, "full_outer")
    table = F.coalesce("expected", "name").alias("name")
    found = complete.where(F.col("expected").isNull() | F.col("name").isNull()).select(
        table, F.lit("table set differs from the expected one").alias("problem")
    )
    empty = complete.where(F.col("row_count") <= 0).select(
        table, F.lit("table is empty").alias("problem")
    )
    dates = stats.where(F.col("name").isin(facts)).agg(
        F.count("max_date").alias("dated"),
        F.min("max_date").alias("lowest"),
        F.max("max_date").alias("highest"),
    )
    agree = (F.col("dated") == len(facts)) & (F.col("lowest") == F.col("highest"))
    uneven = dates.where(~agree).select(
        F.lit("facts").alias("name"), F.lit("fact max dates differ").alias("problem")
    )
    problems = found.unionByName(empty).unionByName(uneven)
    if expected_end is not None:
        short = dates.where(agree & (F.col("highest") < F.lit(expected_end.isoformat()))).select(
            F.lit("facts").alias("name"), F.lit("requested end date not reached").alias("problem")
        )
        problems = problems.unionByName(short)
    return problems


def manifest_watermark(max_dates: dict[str, str | None]) -> date:
    """The date all facts of a published release reach."""
    reached = []
    for spec in FACT_SPECS:
        if max_dates.get(spec.name) is None:
            raise ValueError(f"manifest has no max date for {spec.name}")
        reached.append(max_dates[spec.name])
    if min(reached) != max(reached):
        raise ValueError("fact table watermarks differ")
    return date.fromisoformat(reached[0])


def publish_range(
    max_dates: dict[str, str | None],
    target: date,
    start: date | None = None,
    end: date | None = None,
    force: bool = False,
) -> tuple[date, date] | None:
    """Date window the next release has to cover, or None when nothing is missing.

    Without bounds: the day after the current watermark up to ``target``. With bounds, a
    repair of exactly that window, which has to be forced.
    """
    bounded = start is not None or end is not None
    if bounded != force:
        raise ValueError(
            "a bounded repair has to be forced" if bounded else "a forced publish needs bounds"
        )
    if bounded:
        if start is None or end is None:
            raise ValueError("a repair needs both a start and an end date")
        if start > end:
            raise ValueError("start must not be after end")
        return start, end
    reached = manifest_watermark(max_dates)
    return None if target <= reached else (reached + timedelta(days=1), target)


def _beyond_retention(listing: DataFrame, active: str, keep: int) -> DataFrame:
    """Listed files with their release id, those of releases to give up only.

    Ids sort by time, so everything older than the ``keep``-th newest id up to the active
    one goes. Only that one id is looked up; files are not joined or grouped.
    """
    if keep < 1:
        raise ValueError("keep must be positive")
    files = listing.withColumn("release_id", release_id(F.col("path")))
    upto = files.where(F.col("release_id") <= active).select("release_id").distinct()
    newest = upto.orderBy(F.desc("release_id")).limit(keep)
    oldest_kept = newest.select(F.min("release_id")).scalar()
    return files.where((F.col("release_id") < oldest_kept) & (F.col("release_id") != active))


def deletable_files(listing: DataFrame, active: str, keep: int = KEPT_RELEASES) -> DataFrame:
    """Files of the releases that retention gives up.

    Of the releases up to the active one the newest ``keep`` stay, and the active one
    always does. Newer ones (not activated yet) and malformed paths are never touched.
    """
    return _beyond_retention(listing, active, keep)


def deletable_folders(
    listing: DataFrame, active: str, keep: int, referred: DataFrame
) -> DataFrame:
    """(release_id, folder) of table folders that retention gives up and no kept release refers
    to. ``referred`` holds the kept releases' (release_id, name, month)."""
    files = _beyond_retention(listing, active, keep).select(
        "release_id", table_folder(F.col("path")).alias("folder"), *table_part(F.col("path"))
    )
    return (
        files.where("folder IS NOT NULL")
        .distinct()
        .join(referred, ["release_id", "name", "month"], "left_anti")
        .select("release_id", "folder")
    )


def deletable_releases(listing: DataFrame, active: str, keep: int = KEPT_RELEASES) -> DataFrame:
    """Ids of the releases that retention gives up."""
    return _beyond_retention(listing, active, keep).select("release_id").distinct()


def release_summary(manifest: DataFrame) -> DataFrame:
    """Rows, bytes over both formats and last date per published table."""
    return manifest.select(
        "name",
        F.col("row_count").alias("rows"),
        (F.col("parquet_bytes") + F.col("csv_bytes")).alias("bytes"),
        "max_date",
    )
