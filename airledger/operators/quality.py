"""Range validation, key checks and referential checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airledger.functions.rules import (
    COORDINATE_RULES,
    RangeRule,
    any_violation,
    applicable,
    violation_count,
    violation_structs,
)


def valid_rows(rows: DataFrame, rules: Sequence[RangeRule]) -> DataFrame:
    """Rows without any violation. One boolean expression, no array is built."""
    return rows.where(~any_violation(applicable(tuple(rules), rows.columns)))


def rejected_rows(rows: DataFrame, rules: Sequence[RangeRule]) -> DataFrame:
    return rows.where(any_violation(applicable(tuple(rules), rows.columns)))


def error_rows(
    rows: DataFrame, rules: Sequence[RangeRule], source_table: str, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per violated rule. Only rejected rows pay for building the error list."""
    used = applicable(tuple(rules), rows.columns)
    return rejected_rows(rows, used).select(
        F.lit(source_table).alias("source_table"),
        "district_id",
        *keep,
        F.inline(violation_structs(used)),
    )


def count_outcomes(rows: DataFrame, rules: Sequence[RangeRule]) -> DataFrame:
    """Loaded rows, skipped (rejected) rows and total violations, in one pass."""
    used = applicable(tuple(rules), rows.columns)
    bad = any_violation(used)
    return rows.agg(
        F.count_if(~bad).alias("rows_loaded"),
        F.count_if(bad).alias("rows_skipped"),
        F.coalesce(F.sum(violation_count(used)), F.lit(0)).cast("long").alias("total_rejected"),
    )


VIOLATIONS = "violations"


def judged(rows: DataFrame, rules: Sequence[RangeRule]) -> DataFrame:
    """Rows with the number of rules they violate: stored, it spares readers the measures."""
    used = applicable(tuple(rules), rows.columns)
    return rows.withColumn(VIOLATIONS, violation_count(used))


def count_judged(rows: DataFrame) -> DataFrame:
    """What ``count_outcomes`` finds, from the numbers of ``judged``."""
    return rows.agg(
        F.count_if(F.col(VIOLATIONS) == 0).alias("rows_loaded"),
        F.count_if(F.col(VIOLATIONS) > 0).alias("rows_skipped"),
        F.coalesce(F.sum(VIOLATIONS), F.lit(0)).cast("long").alias("total_rejected"),
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; counts are combined before the shuffle."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct child values with no parent row. Null references nothing."""
    values = child.where(F.col(column).isNotNull()).select(column).distinct()
    return values.join(
        parent.select(F.col(parent_column).alias(column)), column, "left_anti"
    )


def coordinate_errors(districts: DataFrame) -> DataFrame:
    """Districts outside the permitted area."""
    return error_rows(districts, COORDINATE_RULES, "analyst.dim_district")


def require_empty(df: DataFrame, message: str, most: int | None = 5) -> None:
    """Fail unless ``df`` is empty, quoting up to ``most`` offending rows and how many there are.

    ``most`` is None only where the rows are few because a caller listed them.
    """
    sample = (df if most is None else df.limit(most)).collect()
    if sample:
        count = len(sample) if most is None or len(sample) < most else df.count()
        raise ValueError(f"{message} ({count}): {[row.asDict() for row in sample]}")


def require_unique(df: DataFrame, key: Sequence[str], table: str) -> None:
    require_empty(duplicate_keys(df, key), f"{table} delta contains duplicate primary keys")
