"""A global ordinal without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airledger.schemas import TableSpec
from airledger.session import Staging

ORDINAL = "ordinal"
_ROW_BITS = 33


def with_ordinal(
    stage: Staging, df: DataFrame, order: Sequence[str | Column], label: str
) -> DataFrame:
    """``df`` with ``ordinal``, 1 for the first row by ``order``; equal rows follow in any order.

    Rows are dealt out by ranges of ``order`` and sorted where they are; the result is stored
    with each row's place in its partition. What comes before a partition is a sum over one
    row per partition, so no task sees more than its own range.
    """
    number = F.monotonically_increasing_id()
    placed = stage.put(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "_part": F.shiftright(number, _ROW_BITS),
                "_row": number.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
            }
        ),
        label,
    )
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(offsets, "_part")
        .withColumn(ORDINAL, F.col("_before") + F.col("_row") + 1)
        .drop("_part", "_row", "_before")
    )


def export_ordered(stage: Staging, table: DataFrame, spec: TableSpec) -> DataFrame:
    """A table's rows numbered in the order of its primary key, in which they are exported."""
    return with_ordinal(stage, table.select(*spec.columns), spec.primary_key, spec.name)
