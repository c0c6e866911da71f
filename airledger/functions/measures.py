"""Type changes for measure columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import types as T


def widen(column: Column, kind: T.DataType, target: T.DataType) -> Column:
    """Released form of a stored column.

    A real is widened through its decimal text, so 21.1 stays 21.1 rather than becoming
    21.100000381469727.
    """
    if isinstance(kind, T.FloatType) and isinstance(target, T.DoubleType):
        return column.cast("string").cast(target)
    return column if kind == target else column.cast(target)
