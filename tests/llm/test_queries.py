"""The queries of this subpackage: against SQL where there is some, else they must run and give unique rows."""

import pytest

from harvestry.llm import queries

from ..oracle import compare

QUERIES, SQL = queries.queries(), queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, small, name):
    compare(spark, small, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - set(SQL) if n != "p8_ids"))
def test_query_runs_and_repeats_no_row(spark, small, name):
    df = QUERIES[name](spark, small).cache()
    assert df.count() == df.distinct().count() > 0


def test_ids_of_every_document(spark, small):
    assert QUERIES["p8_ids"](spark, small).count() == spark.read.parquet(f"{small}/documents.parquet").count()
