"""Quality of ranked results against rated documents."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("precision", "recall", "mean_reciprocal_rank", "dcg", "ndcg")


def rank_eval(
    results: DataFrame,
    ratings: DataFrame,
    metric: str = "precision",
    k: int = 10,
    relevant_rating: int = 1,
    queries: DataFrame | None = None,
) -> DataFrame:
    """Per query `(query_id, hits, relevant, unrated, metric_score)`.

    `results` has `query_id, _id, _score`, `ratings` has `_id, rating` and, when
    a document is rated per query, `query_id`. Where both have `_index`, documents
    are told apart by it too. `ndcg` divides the gain by that of the `k` best
    ratings in the best order, of the query or else of all; without a rated
    document it is 0. Only the first `k` results of a
    query count; an unrated one is not relevant. A query of `queries` without
    results scores 0. `mean_score` gives the mean over the queries.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; known: {METRICS}")
    keys = [c for c in ("query_id", "_index", "_id") if c in ratings.columns and c in results.columns]
    ties = [c for c in ("_id", "_index") if c in results.columns]
    best = Window.partitionBy("query_id").orderBy(F.desc("_score"), *ties)
    top = results.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= k)
    rated = top.join(ratings.select(*keys, "rating"), keys, "left")
    rating = F.coalesce("rating", F.lit(0))
    is_relevant = rating >= relevant_rating
    scored = rated.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("hits"),
        F.count_if(is_relevant).alias("relevant"),
        F.count_if(F.col("rating").isNull()).alias("unrated"),
        F.min(F.when(is_relevant, F.col("_rank"))).alias("_first"),
        F.sum(_gain(rating)).alias("_dcg"),
    )
    if metric == "ndcg":
        scored = _with_ideal(scored, ratings, k, "query_id" in keys)
    if metric == "recall":
        if "query_id" not in keys:
            raise ValueError("recall needs ratings per query")
        rated_relevant = ratings.filter(F.col("rating") >= relevant_rating).groupBy("query_id")
        scored = scored.join(rated_relevant.agg(F.count(F.lit(1)).alias("_all")), "query_id", "left")
    if queries is not None:
        scored = queries.select("query_id").join(scored, "query_id", "left").fillna(0, ["hits", "relevant", "unrated"])
    return scored.select(
        "query_id", "hits", "relevant", "unrated", F.round(F.coalesce(_score(metric), F.lit(0.0)), 6).alias("metric_score")
    )


def _gain(rating: Column) -> Column:
    return (F.pow(F.lit(2.0), rating) - 1) / F.log2(F.col("_rank") + 1)


def _with_ideal(scored: DataFrame, ratings: DataFrame, k: int, per_query: bool) -> DataFrame:
    """`scored` with `_ideal`, the gain of the `k` best ratings in the best order."""
    if not per_query:
        top = [r["rating"] for r in ratings.filter("rating IS NOT NULL").orderBy(F.desc("rating")).limit(k).select("rating").collect()]
        return scored.withColumn("_ideal", F.lit(float(sum((2.0**r - 1) / math.log2(n + 2) for n, r in enumerate(top)))))
    order = Window.partitionBy("query_id").orderBy(F.desc("rating"))
    placed = ratings.filter("rating IS NOT NULL").withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)
    return scored.join(placed.groupBy("query_id").agg(F.sum(_gain(F.col("rating"))).alias("_ideal")), "query_id", "left")


def mean_score(per_query: DataFrame) -> DataFrame:
    """The mean over the queries of `rank_eval`, one row."""
    return per_query.agg(
        F.count(F.lit(1)).alias("queries"), F.round(F.avg("metric_score"), 6).alias("metric_score")
    )


def _score(metric: str) -> Column:
    if metric == "precision":
        return F.try_divide(F.col("relevant"), F.col("hits"))
    if metric == "recall":
        return F.try_divide(F.col("relevant"), F.col("_all"))
    if metric == "mean_reciprocal_rank":
        return 1 / F.col("_first")
    if metric == "ndcg":
        return F.try_divide(F.col("_dcg"), F.col("_ideal"))
    return F.col("_dcg")
