"""Every registered query runs; every one with check SQL agrees with DuckDB."""

import re

import pytest
from oracle import compare

import __spark_entry__ as entry_point

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()
# The training-data queries without SQL have tests of their own beside brute force.
MODELS = sorted(q for q in set(QUERIES) - set(ORACLES) if not re.match(r"op\d+_|pipeline$", q))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(name, spark, data, duck):
    assert compare(QUERIES[name](spark, data), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", MODELS)
def test_query_without_sql_gives_rows(name, spark, data):
    df = QUERIES[name](spark, data)
    assert len(set(df.columns)) == len(df.columns)
    assert not df.isEmpty()


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["order_date", "category", "orders", "revenue"]


def test_no_oracle_without_query():
    assert set(ORACLES) <= set(QUERIES)
