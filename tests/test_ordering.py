"""Global ordinals and foreign keys checked together."""

import random

from helpers import rows

from airledger.operators.integrity import foreign_key_orphans
from airledger.operators.ordering import with_ordinal
from airledger.session import staging


def test_ordinals_count_rows_in_order(spark):
    rng = random.Random(4)
    values = [(rng.randrange(300), rng.choice("abc"), i) for i in range(1000)]
    df = spark.createDataFrame(values, "a int, b string, i int").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        with staging(spark, "test") as stage:
            found = with_ordinal(stage, df, ["a", "b", df.i.desc()], "rows")
            assert found.columns == ["a", "b", "i", "ordinal"]
            got = sorted(tuple(r) for r in found.select("ordinal", "a", "b", "i").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    want = sorted(values, key=lambda v: (v[0], v[1], -v[2]))
    assert got == [(n, *v) for n, v in enumerate(want, 1)]


def test_ordinals_of_nothing(spark):
    with staging(spark, "test") as stage:
        assert with_ordinal(stage, spark.range(0), ["id"], "rows").count() == 0


def test_orphans_of_several_keys_in_one_pass(spark):
    keys = [("c", "x", "p", "id"), ("c", "y", "q", "id"), ("d", "x", "p", "id")]
    tables = {
        "c": spark.createDataFrame([(1, 1), (1, 2), (3, None), (None, 9), (3, 9)], "x int, y bigint"),
        "d": spark.createDataFrame([(2,), (1,)], "x smallint"),
        "p": spark.createDataFrame([(1,)], "id int"),
        "q": spark.createDataFrame([(2,)], "id int"),
    }
    found = foreign_key_orphans(tables, keys)
    assert rows(found, "child_table", "child_column", "parent_table", "value", "rows") == [
        ("c", "x", "p", 3, 2), ("c", "y", "q", 1, 1), ("c", "y", "q", 9, 2), ("d", "x", "p", 2, 1),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
