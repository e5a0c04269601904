"""Every registered query against its SQL on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry_points
from docquery.plans import catalog

QUERIES, SQL = catalog.QUERIES, catalog.SQL


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, con, name):
    assert oracle.difference(QUERIES[name](spark, sf), con, SQL[name]) is None


def test_all_queries_have_sql():
    assert set(SQL) == set(QUERIES)
    assert set(SQL) <= set(entry_points.oracle_sql())
    assert set(QUERIES) <= set(entry_points.queries())


def test_entry(spark):
    hits = entry_points.entry(spark)
    assert hits.columns == ["_index", "_id", "_score", "lang"]
    scores = [h["_score"] for h in hits.collect()]
    assert scores and scores == sorted(scores, reverse=True)
