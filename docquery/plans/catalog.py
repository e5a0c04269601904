"""All registered queries by name, and the SQL of those that SQL can say."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docquery.plans import cast_plans, document_plans, search_plans, table_plans

_PARTS = (search_plans, document_plans, cast_plans, table_plans)


def _in_utc(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {name: _in_utc(query) for part in _PARTS for name, query in part.QUERIES.items()}
SQL = {name: sql for part in _PARTS for name, sql in part.SQL.items()}
