"""Parameterised queries: one set of values, or a whole table of them in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docquery.operators.range_join import range_join, range_top

#: Largest table of parameters, in bytes of its rows as JSON, that is sent to all executors.
PARAMETER_BYTES = 64 << 20


def search_template(
    spark: SparkSession, template: str, params: Mapping | None = None, stored: Mapping[str, str] | None = None
) -> DataFrame:
    """Run a query with named parameters (`:name`) over the session's tables and views.

    `template` is the query itself, or the name of one in `stored`.
    """
    return spark.sql((stored or {}).get(template, template), args=dict(params or {}))


def msearch_template(
    df: DataFrame,
    params: DataFrame,
    equal: Mapping[str, str] | None = None,
    where: Column | None = None,
    size: int | None = 10,
    sort: Sequence[Column] = (),
    between: Mapping[str, tuple[str | None, str | None]] | None = None,
) -> DataFrame:
    """One template, many parameter rows: hits keyed by `query_id`.

    `equal` names the columns of `df` that must equal a parameter; they are the
    join key. `between` names columns that must lie between two parameters, both
    included; a bound of None is open. Without an equality the first of these is the
    join key, by ranges of equal share. `where` is the rest of the
    template over the columns of both sides. `size=None` keeps all hits, otherwise the first `size` of each query
    by `sort`, or else by `_id`, cut inside every partition before anything moves. Where one
    range is the whole template and `sort` needs no parameter, only rows that can be among the first are joined.
    """
    if not equal and not between:
        raise ValueError("a template needs an equality or a range")
    if size is not None and not sort and "_id" not in df.columns:
        raise ValueError("a limited template needs an order")
    sort = list(sort) or [F.col("_id")]
    condition = F.lit(True) if where is None else where
    for column, (low, high) in (between or {}).items():
        if low is not None:
            condition = condition & (F.col(column) >= F.col(low))
        if high is not None:
            condition = condition & (F.col(column) <= F.col(high))
    if equal:
        for column, parameter in equal.items():
            condition = condition & (F.col(column) == F.col(parameter))
        hits = df.join(F.broadcast(params) if _small(params) else params, condition)
    else:
        column, (low, high) = next(iter(between.items()))
        if size is not None and where is None and len(between) == 1 and _sorts(df, sort):
            hits = range_top(df, params, column, low, high, size, sort, small=_small)
        else:
            hits = range_join(df, params, column, low, high, small=_small).filter(condition)
    if size is None:
        return hits
    best = Window.partitionBy("query_id").orderBy(*sort)
    return hits.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= size)


def _sorts(df: DataFrame, sort: Sequence[Column]) -> bool:
    """Whether an order needs the columns of a table only."""
    try:
        return bool(df.orderBy(*sort).schema)
    except AnalysisException:
        return False


def _small(params: DataFrame, max_rows: int = 100_000) -> bool:
    """Whether a table of parameters has few enough rows and bytes to be sent to all executors."""
    row = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in params.columns])))
    found = params.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()
    return found["n"] <= max_rows and found["bytes"] <= PARAMETER_BYTES
