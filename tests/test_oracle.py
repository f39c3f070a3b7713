"""Every registered query with SQL gives the rows DuckDB gives."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from conftest import DATA

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, DATA), con, ORACLE[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "Purchase_Channel", "num_orders", "total_revenue", "aov", "avg_satisfaction", "avg_return_rate",
    ]
