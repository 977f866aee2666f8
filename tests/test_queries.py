"""Every registered query at the smallest scale, against DuckDB where it has SQL."""

import pytest

import __spark_entry__ as entry
from check import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "avg_occupancy" in df.columns


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    problem = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
