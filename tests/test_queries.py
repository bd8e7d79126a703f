"""Every registered query of the core against its SQL; those without SQL must run."""

import pytest

from harvestry.plans import registry

from .oracle import compare

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, small, name):
    compare(spark, small, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)


def test_no_sql_without_query():
    assert not set(SQL) - set(QUERIES)
