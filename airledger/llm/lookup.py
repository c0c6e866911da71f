"""A join to one row per key that no single key can slow down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_KEYS = 10_000


def looked_up(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``labels``, which holds every ``key`` once.

    ``labels.held`` counts the rows of each key and isn't among the columns added. Keys with more
    than a ``HEAVY_KEYS``th of all rows, fewer than ``HEAVY_KEYS`` whatever the size of the
    input, are broadcast, so their rows stay where they are; the others are joined by Spark's
    choice, and none of them fills more than its small share of a task.
    """
    total = labels.agg(F.sum("held")).first()[0] or 0
    heavy = labels.where(F.col("held") * HEAVY_KEYS > total).drop("held")
    light = labels.where(F.col("held") * HEAVY_KEYS <= total).drop("held")
    few = F.broadcast(heavy)
    return rows.join(few, key).unionByName(
        rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    )
