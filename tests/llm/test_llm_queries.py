"""The registered queries with SQL against it, on the smallest tables."""

import oracle
import pytest

import corpus_pipeline
from docquery.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf, name):
    assert oracle.difference(queries.QUERIES[name](spark, sf), oracle.connect(sf), queries.SQL[name]) is None


def test_pipeline_runs(spark, sf):
    packed = corpus_pipeline.run(spark, sf)
    assert packed.count() > 0
