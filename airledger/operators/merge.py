"""Keyed merge of a delta into a table.

Two forms of the same rule (a delta row replaces the whole current row, nulls included):

``fold_delta``     groups both sides by key. It also collapses repeated keys inside the
                   current side. Values are picked with ``max_by`` so that copies of a key are
                   combined before the shuffle and one much-repeated key stays cheap.
``replace_delta``  needs a current side whose key is unique, which every table written by
                   this package has. Current rows without a delta row pass straight through;
                   a delta below the broadcast threshold causes no shuffle of the current side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.schemas import TableSpec
from airledger.sources.tables import conform

_PRIORITY = "_priority"
PARTITION_COLUMN = "month_key"


def require_known_columns(df: DataFrame, spec: TableSpec) -> None:
    unknown = sorted(set(df.columns) - set(spec.columns) - {PARTITION_COLUMN})
    if unknown:
        raise ValueError(f"unknown columns for {spec.name}: {unknown}")


def normalise(df: DataFrame, spec: TableSpec, schema: T.StructType | None = None) -> DataFrame:
    """Table order and types, absent columns as null, unknown columns refused."""
    require_known_columns(df, spec)
    target = schema or spec.stored
    if PARTITION_COLUMN in df.columns:
        target = T.StructType([*target.fields, T.StructField(PARTITION_COLUMN, T.IntegerType())])
    return conform(df, target)


def absent_columns(delta: DataFrame, spec: TableSpec) -> list[str]:
    return [c for c in spec.values if c not in delta.columns]


def latest_per_key(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The row with the greatest ``order`` for each key, whole rows only.

    ``order`` must be unique within a key. With fixed-width columns this is a hash
    aggregate with map-side combine, whatever the number of copies of a key.
    """
    values = [c for c in df.columns if c not in (*key, order)]
    return df.groupBy(*key).agg(
        *[F.max_by(c, order).alias(c) for c in values], F.max(order).alias(order)
    )


def fold_delta(
    current: DataFrame | None,
    delta: DataFrame,
    spec: TableSpec,
    *,
    schema: T.StructType | None = None,
    keep_absent: bool = False,
) -> DataFrame:
    """Merge that tolerates repeated keys in ``current``.

    ``keep_absent``: columns the delta does not have keep their current value instead of
    becoming null.
    """
    target = schema or spec.stored
    kept = set(absent_columns(delta, spec)) if keep_absent else set()
    incoming = normalise(delta, spec, target)
    if current is None:
        return incoming.select(*spec.columns)
    both = (
        normalise(current, spec, target)
        .select(*spec.columns)
        .withColumn(_PRIORITY, F.lit(0))
        .unionByName(incoming.select(*spec.columns).withColumn(_PRIORITY, F.lit(1)))
    )
    older = F.when(F.col(_PRIORITY) == 0, F.lit(0))
    picked = [
        F.max_by(c, older if c in kept else F.col(_PRIORITY)).alias(c) for c in spec.values
    ]
    return both.groupBy(*spec.primary_key).agg(*picked).select(*spec.columns)


def replace_delta(
    current: DataFrame,
    delta: DataFrame,
    spec: TableSpec,
    *,
    schema: T.StructType | None = None,
    keep_absent: bool = False,
) -> DataFrame:
    """Merge into a ``current`` side whose key is unique."""
    key = list(spec.primary_key)
    incoming = normalise(delta, spec, schema)
    existing = normalise(current, spec, schema)
    kept = absent_columns(delta, spec) if keep_absent else []
    if kept:
        incoming = incoming.drop(*kept).join(existing.select(*key, *kept), key, "left")
    untouched = existing.join(incoming.select(*key), key, "left_anti")
    return untouched.unionByName(incoming.select(*existing.columns))


def new_rows(existing: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not there yet; existing rows are left alone."""
    return rows.join(existing.select(*key), list(key), "left_anti")
