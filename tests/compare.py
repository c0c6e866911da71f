"""Run a query on Spark and its SQL counterpart on DuckDB and compare the results."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf):
    df = query(spark, sf)
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    theirs = _rows(names, expected.fetchall())
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(ours) == len(theirs), (len(ours), len(theirs))
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not wrong, f"{len(wrong)} rows differ, e.g. {wrong[0]}"
    return len(ours)
