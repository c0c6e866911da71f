"""Foreign keys, all of them at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airledger.schemas import FOREIGN_KEYS

ForeignKey = tuple[str, str, str, str]


def foreign_key_orphans(
    tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey] = FOREIGN_KEYS
) -> DataFrame:
    """(child_table, child_column, parent_table, value, rows) for values without a parent row.

    Each child table is read once for all its keys. Values are counted before they are
    shuffled, so a district that holds a third of all rows travels as one row per task, and
    all keys are compared with all parents in one anti join. Null refers to nothing.
    """
    parents = sorted({(parent, column) for _, _, parent, column in keys})
    children = sorted({child for child, _, _, _ in keys})
    held = [
        tables[child].select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(i).alias("key"),
                            F.lit(parents.index((parent, parent_column))).alias("parent"),
                            F.col(column).cast("long").alias("value"),
                        )
                        for i, (name, column, parent, parent_column) in enumerate(keys)
                        if name == child
                    ]
                )
            )
        )
        for child in children
    ]
    offered = [
        tables[parent].select(F.lit(i).alias("parent"), F.col(column).cast("long").alias("value"))
        for i, (parent, column) in enumerate(parents)
    ]
    values = (
        reduce(DataFrame.unionAll, held)
        .where("value IS NOT NULL")
        .groupBy("key", "parent", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    lost = values.join(reduce(DataFrame.unionAll, offered), ["parent", "value"], "left_anti")

    def named(part: int):
        return F.element_at(F.array(*[F.lit(k[part]) for k in keys]), F.col("key") + 1)

    return lost.select(
        named(0).alias("child_table"),
        named(1).alias("child_column"),
        named(2).alias("parent_table"),
        "value",
        "rows",
    )


def keys_of(table: str) -> list[ForeignKey]:
    return [key for key in FOREIGN_KEYS if key[0] == table]


def require_parents(table: str, rows: DataFrame, parents: Mapping[str, DataFrame]) -> None:
    """Refuse rows of ``table`` that refer to keys its parents don't have."""
    keys = keys_of(table)
    if not keys:
        return
    lost = foreign_key_orphans({table: rows, **parents}, keys)
    found = lost.limit(5).collect()
    if found:
        named = ", ".join(sorted({row.parent_table for row in found}))
        sample = [(row.child_column, row.value, row.rows) for row in found]
        count = len(found) if len(found) < 5 else lost.count()
        raise ValueError(f"{table} refers to keys missing from {named} ({count}): {sample}")
