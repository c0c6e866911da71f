"""Columns computed from one text column by Python code, all other columns passing through."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from airledger.llm.tables import ship_code

ROWS_AT_ONCE = 256


def with_columns(
    docs: DataFrame, fields: list[T.StructField], work: Callable[[str | None], tuple]
) -> DataFrame:
    """``docs`` with ``fields``, whose values ``work`` gives for each text; a map without shuffle.

    Columns named like ``fields``, or ``_source``, are replaced.
    """
    ship_code(docs.sparkSession)
    names = [f.name for f in fields]
    docs = docs.drop(*names, "_source").withColumn("_source", F.col("text").cast("string"))
    kinds = [to_arrow_type(f.dataType) for f in fields]
    schema = T.StructType([*docs.schema.fields[:-1], *fields])
    columns = schema.names

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(begin, ROWS_AT_ONCE)
                rows = [work(text) for text in part.column(part.num_columns - 1).to_pylist()]
                new = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], names=columns)

    return docs.mapInArrow(each, schema)


def replaced_text(docs: DataFrame, found: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` from ``found``, with column ``text`` of it as the text.

    ``n_chars`` follows where the text has changed; rows whose new text is null where the old
    one wasn't keep null.
    """
    changed = ~F.col("text").eqNullSafe(F.col(text))
    out = []
    for c, kind in docs.dtypes:
        if c == "text":
            out.append(F.col(text).alias(c))
        elif c == "n_chars":
            out.append(F.when(changed, F.length(text).cast(kind)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return found.select(*out)
