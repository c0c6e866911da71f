"""Every registered query against its SQL counterpart, on the smallest generated tables."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
# What airledger.llm registers has tests of its own.
QUERIES, ORACLES = entry_point.QUERIES, entry_point.ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")


@pytest.fixture(scope="module")
def con():
    connection = connect(SF)
    yield connection
    connection.close()


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    compare(spark, con, QUERIES[name], ORACLES[name], SF)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[:3] == ["district_id", "district_name", "observed_date"]
    assert df.count() > 0
