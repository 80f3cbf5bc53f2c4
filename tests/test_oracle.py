"""Every registered query against an independent engine, on whole small tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, data, duck, name):
    got = compare(spark, duck, QUERIES[name], SQL[name], data)
    assert got["names"] and not got["types"], got
    assert got["equal"], got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
