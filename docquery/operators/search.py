"""Searching, scoring and paging documents.

BM25 with k1 = 1.2 and b = 0.75 (Robertson and Zaragoza, 2009):

    idf   = ln(1 + (N - df + 0.5) / (df + 0.5))
    score = sum over terms of idf * tf / (tf + k1 * (1 - b + b * dl / avgdl))

N, df and avgdl hold for the whole scan, before any `where` filter; N counts the
documents that have a token. Scores are rounded to six places and ties go to the
lower `_id`.

Analyzing text is by far the dearest step, so every search analyzes each
document once: the few numbers it needs of a document are written to the shared
folder, and statistics, scores and ranks are taken from those.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquery.functions.text import Analyzer, analyzer, each, query_terms, term_count, term_frequencies
from docquery.model import without
from docquery.session import bounded_broadcast, materialize

K1, B = 1.2, 0.75

#: What tells a pair of a query and a document apart.
PAIR = ("query_id", "_index", "_id")
#: For a floor of the best scores, so many documents per hit asked for are scored, those that the query's rarest terms speak for.
SEEDS = 5
#: Partial scores leave out terms that give a document at most this part of the floor.
LEFT_OUT = 0.2
#: Scores are compared after rounding, so a floor lies a little below the score it comes from.
MARGIN = 1e-5

#: Pairs of a query and a document that a task should hold at once.
PAIRS = 1 << 20

#: Up to so many hits are fetched by a filter on their ids; more are joined. The answer is the same.
MAX_SIZE = 10_000


def search(
    df: DataFrame,
    text_col: str,
    text: str,
    where: Column | None = None,
    size: int = 10,
    sort: Sequence[tuple[Column, bool]] | None = None,
    by: str | Analyzer = "standard",
) -> DataFrame:
    """Filter, score, order: the top `size` hits `(_index, _id, _score, _source)`.

    `sort` replaces the order by score with `(column, descending)` pairs; ties
    go to the lower `_id`. Nothing is shuffled: counting is one projection, the
    statistics one aggregation, the ranking a top-k, after which the documents
    of the `size` winners are fetched by a filter on their ids, or by a join
    where they are too many for that.
    """
    keys = list(sort or [])
    order = [F.desc(f"_key{n}") if down else F.asc(f"_key{n}") for n, (_, down) in enumerate(keys)]
    order = [*(order or [F.desc("_score")]), F.col("_id")]
    scored = _scored(df, text_col, text, where, [col.alias(f"_key{n}") for n, (col, _) in enumerate(keys)], by)
    top = scored.orderBy(*order).limit(size)
    if size > MAX_SIZE:
        chosen = top.select(F.col("_id").alias("_hit"), F.col("_index").alias("_hit_index"), *without(top, "_id", "_index"))
        match = (F.col("_id") == F.col("_hit")) & F.col("_index").eqNullSafe(F.col("_hit_index"))
        return with_index(df).join(chosen, match).orderBy(*order).limit(size).select("_index", "_id", "_score", "_source")
    # At most `size` rows: the answer itself.
    hits = df.sparkSession.createDataFrame(top.collect(), top.schema)
    winners = hits.select(F.col("_id").alias("_hit"), F.col("_index").alias("_hit_index"), *without(hits, "_id", "_index"))
    found = with_index(df).filter(F.col("_id").isin([row["_hit"] for row in winners.select("_hit").collect()]))
    same = (F.col("_id") == F.col("_hit")) & F.col("_index").eqNullSafe(F.col("_hit_index"))
    joined = found.join(F.broadcast(winners), same)
    return joined.orderBy(*order).limit(size).select("_index", "_id", "_score", "_source")


def scores(
    df: DataFrame, text_col: str, text: str, where: Column | None = None, by: str | Analyzer = "standard"
) -> DataFrame:
    """`(_index, _id, _score)` of every match, in no order; for `paging.page` and `paging.number_pages`."""
    return _scored(df, text_col, text, where, [], by)


def count(df: DataFrame, where: Column | None = None) -> DataFrame:
    """One row with the number of matching documents."""
    rows = df if where is None else df.filter(where)
    return rows.agg(F.count(F.lit(1)).alias("count"))


def explain(df: DataFrame, text_col: str, text: str, ids: DataFrame, by: str | Analyzer = "standard") -> DataFrame:
    """Why each asked document matches: one row per document and query term.

    `ids` has `_id` and, where only the documents of some indices are meant,
    `_index`; the result tells the index of each document. A document without the
    term, or one the table does not have, gives `matched = false`.
    """
    terms = query_terms(text, by, df.sparkSession)
    counts = _counts(df, analyzer(by)(F.col(text_col)), terms, [])
    stats = _statistics(counts, len(terms))
    keys = ["_index", "_id"] if "_index" in ids.columns else ["_id"]
    asked = ids.select(*keys).distinct()
    docs = counts.join(bounded_broadcast(asked), keys, "left_semi").select("_index", "_id", "_length", "_tf")
    entries = F.array(
        *[
            F.struct(
                F.lit(term).alias("term"),
                F.lit(stats["df"][n]).cast("long").alias("df"),
                F.lit(_idf(stats, n)).alias("idf"),
                F.coalesce(F.get("_tf", F.lit(n)), F.lit(0)).cast("long").alias("tf"),
            )
            for n, term in enumerate(terms)
        ]
    )
    detail = asked.join(docs, keys, "left").select("_index", "_id", "_length", F.inline(entries)).withColumn(
        "norm", K1 * (1 - B + B * F.col("_length") / F.lit(stats["avgdl"]))
    )
    part = F.col("idf") * F.col("tf") / (F.col("tf") + F.col("norm"))
    return detail.select(
        "_index",
        "_id",
        "term",
        (F.col("tf") > 0).alias("matched"),
        "tf",
        "df",
        F.round("idf", 6).alias("idf"),
        F.round("norm", 6).alias("norm"),
        F.round(F.coalesce(part, F.lit(0.0)), 6).alias("contribution"),
    )


def msearch(
    docs: DataFrame,
    text_col: str,
    queries: DataFrame,
    size: int = 10,
    default_index: str | None = None,
    by: str | Analyzer = "standard",
) -> DataFrame:
    """Many searches in one job: the top `size` hits `(query_id, _rank, _index, _id, _score)` of each query.

    `queries` has `query_id`, `text` and optionally `_index`, the one index the
    query is meant for (else `default_index`, else all). Texts never move: their
    terms, as far as a query has them, are written as a narrow table, from which
    `candidates` picks the few pairs of query and document that can be among the
    best. Only those are scored in full. The answer is the same as if all were.
    """
    asked = materialize(query_terms_table(queries, default_index, by), "query-terms")
    postings = materialize(_postings(docs, text_col, by, asked.select("term").distinct()), "postings")
    totals = postings.filter("term IS NULL").groupBy("_index").agg(*totals_of(F.col("_length")))
    return best_hits(postings.filter("term IS NOT NULL"), totals, asked, size)


def best_hits(entries: DataFrame, totals: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """The top `size` hits of each query from written entries `(_index, _id, _length, term, tf)` of the queries' terms.

    `totals` has `n` and `length` of each index, `asked` comes from `query_terms_table`.
    """
    weights = materialize(term_weights(entries, totals, asked), "weights")
    found, left = candidates(entries, weights, size)
    whole = found.select(*PAIR, F.col("partial").alias("part")).unionByName(_parts_of(found, entries, left))
    scored = whole.groupBy(*PAIR).agg(F.round(F.sum("part"), 6).alias("_score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("_score"), "_id", "_index")
    ranked = scored.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= size)
    return ranked.select("query_id", "_rank", "_index", "_id", "_score")


def candidates(entries: DataFrame, weights: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The pairs `(query_id, _index, _id, partial)` that can be among the `size` best of their query, and the weights still to be added.

    A term gives a document at most its greatest contribution to any. Some
    documents that have a query's rarest terms are scored in full; the `size`-th
    best of them is a floor that the answer does not fall below. Terms whose
    bounds together stay below the floor cannot lift a document over it alone, so
    a candidate has one of the other terms. Partial scores leave out the
    terms with the least bounds, at most `LEFT_OUT` of the floor, and a document
    goes on only if what is left out could still lift it to the floor.

    A query with no floor keeps all its matches, scored in full.
    """
    bounds = entries.join(bounded_broadcast(weights.select("_target", "term", "avgdl").distinct()), "term").filter(_in_target())
    bounds = bounds.groupBy(F.col("_target").alias("_of"), "term").agg(F.max(_share()).alias("most"))
    own = F.col("_target").eqNullSafe(F.col("_of")) & (F.col("w.term") == F.col("b.term"))
    bounded = weights.alias("w").join(bounds.alias("b"), own).select("w.*", (F.col("idf") * F.col("most")).alias("bound"))
    rarest = Window.partitionBy("query_id").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    rarer = F.coalesce(F.sum("df").over(rarest), F.lit(0))
    bounded = materialize(bounded.withColumn("_rare", rarer < SEEDS * size), "bounds")

    seeds = contributions(entries, bounded.filter("_rare")).groupBy(*PAIR).agg(F.sum("part").alias("part"))
    first = Window.partitionBy("query_id").orderBy(F.desc("part"), "_id", "_index")
    seeds = materialize(seeds.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= SEEDS * size).select(*PAIR), "seeds")
    scored = _parts_of(seeds, entries, bounded).groupBy(*PAIR).agg(F.sum("part").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    floors = scored.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") == size).select("query_id", (F.col("score") - MARGIN).alias("floor"))

    least = Window.partitionBy("query_id").orderBy("bound", "term")
    ranked = bounded.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
    ranked = ranked.withColumn("_sum", F.sum("bound").over(least.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("_needed", F.col("_sum") >= F.col("floor")).withColumn("_counted", F.col("_sum") > LEFT_OUT * F.col("floor"))
    left_sum = F.coalesce(F.max(F.when(~F.col("_counted"), F.col("_sum"))).over(Window.partitionBy("query_id")), F.lit(0.0))
    ranked = materialize(ranked.withColumn("_left", left_sum), "ranked")
    counted = ranked.filter("_counted")
    # As many entries meet the weights as these have documents. The entries of a document go to one task, which holds few pairs at a time.
    expected = counted.agg(F.sum("df")).first()[0] or 0
    dealt = entries.join(bounded_broadcast(counted.select("term").distinct()), "term", "left_semi")
    tasks = max(-(-expected // PAIRS), entries.sparkSession.sparkContext.defaultParallelism)
    met = contributions(dealt.repartition(tasks, "_index", "_id"), counted, "_needed", "floor", "_left")
    pairs = met.groupBy(*PAIR).agg(F.sum("part").alias("partial"), F.max("_needed").alias("_needed"), F.max("floor").alias("floor"), F.max("_left").alias("_left"))
    alive = pairs.filter(F.col("_needed") & (F.col("partial") + F.col("_left") >= F.col("floor")))
    return materialize(alive.select(*PAIR, "partial"), "candidates"), ranked.filter("NOT _counted")


def _in_target() -> Column:
    return F.col("_target").isNull() | (F.col("_target") == F.col("_index"))


def _share() -> Column:
    """A term's contribution to a document's score, without the term's weight."""
    return F.col("tf") / (F.col("tf") + K1 * (1 - B + B * F.col("_length") / F.col("avgdl")))


def contributions(entries: DataFrame, weights: DataFrame, *more: str) -> DataFrame:
    """`(query_id, _index, _id, part)` for every entry of a term that has a weight in a query."""
    matched = entries.join(bounded_broadcast(weights), "term").filter(_in_target())
    return matched.select(*PAIR, (F.col("idf") * _share()).alias("part"), *more)


def _parts_of(pairs: DataFrame, entries: DataFrame, weights: DataFrame) -> DataFrame:
    """`(query_id, _index, _id, part)` for given pairs and every term that has a weight. Documents meet by id, terms of a query by both."""
    p, e = bounded_broadcast(pairs.select(*PAIR)).alias("p"), entries.alias("e")
    same = F.col("p._index").eqNullSafe(F.col("e._index")) & (F.col("p._id") == F.col("e._id"))
    met = e.join(p, same).select("p.*", "e._length", "e.term", "e.tf")
    weighed = met.join(bounded_broadcast(weights.select("query_id", "_target", "term", "idf", "avgdl")), ["query_id", "term"]).filter(_in_target())
    return weighed.select(*PAIR, (F.col("idf") * _share()).alias("part"))


def terms_enum(df: DataFrame, terms: Column, prefix: str, size: int = 10, ignore_case: bool = False) -> DataFrame:
    """The first `size` distinct terms of a field that start with a string.

    `terms` is a text column, or an array such as the tokens of a field; arrays
    are narrowed to the prefix before they are exploded.
    """
    wanted = prefix.lower() if ignore_case else prefix

    def starts(value: Column) -> Column:
        return F.startswith(F.lower(value) if ignore_case else value, F.lit(wanted))

    dtype = df.select(terms).schema[0].dataType
    if dtype.typeName() == "array":
        listed = df.select(each(F.array_distinct(F.filter(terms, starts))).alias("term")).filter("term IS NOT NULL")
    else:
        listed = df.select(terms.alias("term")).filter(starts(F.col("term")))
    return listed.distinct().orderBy("term").limit(size)


# -- scoring --------------------------------------------------------------------------------------


def _scored(
    df: DataFrame, text_col: str, text: str, where: Column | None, extra: Sequence[Column], by: str | Analyzer
) -> DataFrame:
    terms = query_terms(text, by, df.sparkSession)
    wanted = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    counts = _counts(df, analyzer(by)(F.col(text_col)), terms, [wanted.alias("_wanted"), *extra])
    stats = _statistics(counts, len(terms))
    matching = counts.filter(F.col("_wanted") & F.exists("_tf", lambda n: n > 0))
    return matching.withColumn("_score", F.round(_score(stats), 6)).drop("_wanted", "_length", "_tf")


def with_index(df: DataFrame) -> DataFrame:
    return df if "_index" in df.columns else df.withColumn("_index", F.lit(None).cast("string"))


def _counts(df: DataFrame, words: Column, terms: Sequence[str], extra: Sequence[Column]) -> DataFrame:
    """`(_index, _id, _length, _tf)`: a document's number of tokens and how often each query term occurs."""
    analyzed = with_index(df).select("_index", "_id", *extra, words.alias("_all"))
    others = [c for c in analyzed.columns if c != "_all"]
    kept = analyzed.select(
        *others, F.size("_all").alias("_length"), F.filter("_all", lambda w: w.isin(list(terms))).alias("_kept")
    )
    tf = F.array(*[term_count(F.col("_kept"), t) for t in terms]).cast("array<int>")
    return materialize(kept.select(*others, "_length", tf.alias("_tf")), "counts")


def _statistics(counts: DataFrame, terms: int) -> dict:
    """Number of documents, their average length and each term's document frequency: one row."""
    row = counts.agg(
        F.count_if(F.col("_length") > 0).alias("n"),
        F.sum(F.greatest("_length", F.lit(0))).alias("length"),
        *[F.count_if(F.get("_tf", F.lit(i)) > 0).alias(f"df{i}") for i in range(terms)],
    ).first()
    return {"n": row["n"], "avgdl": (row["length"] or 0) / row["n"] if row["n"] else 1.0, "df": list(row)[2:]}


def _idf(stats: dict, n: int) -> float:
    df = stats["df"][n]
    return math.log(1 + (stats["n"] - df + 0.5) / (df + 0.5))


def _score(stats: dict) -> Column:
    norm = K1 * (1 - B + B * F.col("_length") / F.lit(stats["avgdl"]))
    score = F.lit(0.0)
    for n in range(len(stats["df"])):
        tf = F.get("_tf", F.lit(n))
        score = score + F.lit(_idf(stats, n)) * tf / (tf + norm)
    return score


def query_terms_table(queries: DataFrame, default_index: str | None, by: str | Analyzer) -> DataFrame:
    """`(query_id, _target, term)`: one row per query and term."""
    index = F.col("_index") if "_index" in queries.columns else F.lit(None).cast("string")
    target = F.coalesce(index, F.lit(default_index).cast("string")).alias("_target")
    words = F.array_distinct(analyzer(by)(F.col("text")))
    return queries.select("query_id", target, each(words).alias("term")).filter("term IS NOT NULL")


def _postings(docs: DataFrame, text_col: str, by: str | Analyzer, vocabulary: DataFrame) -> DataFrame:
    """`(_index, _id, _length, term, tf)` of the vocabulary's terms, made row by row without a shuffle.

    Each document also has one row with a NULL term, which stands for the
    document itself in the totals.
    """
    known = bounded_broadcast(vocabulary.select(F.col("term").alias("_key"), F.lit(True).alias("_known")))
    counted = with_index(docs).select("_index", "_id", analyzer(by)(F.col(text_col)).alias("_words")).select(
        "_index", "_id", F.size("_words").alias("_length"), term_frequencies(F.col("_words")).alias("_terms")
    )
    # The outer form keeps documents without a token, and Spark adds no filter that analyzes the text again.
    itself = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).alias("tf")))
    entries = F.concat(itself, F.coalesce("_terms", F.array().cast("array<struct<term:string,tf:int>>")))
    exploded = counted.select("_index", "_id", "_length", entries.alias("_entries")).select(
        "_index", "_id", "_length", F.inline_outer("_entries")
    )
    # No token holds a space, so these keys match nothing, and NULL terms do not pile up in one task.
    key = F.coalesce("term", F.concat(F.lit(" "), F.col("_id").cast("string")))
    joined = exploded.withColumn("_key", key).join(known, "_key", "left")
    return joined.filter("_known OR term IS NULL").drop("_key", "_known")


def totals_of(length: Column) -> list[Column]:
    """The number of documents with a token, `n`, and of their tokens, `length`."""
    return [F.count_if(length > 0).alias("n"), F.coalesce(F.sum(F.greatest(length, F.lit(0))), F.lit(0)).alias("length")]


def term_weights(entries: DataFrame, totals: DataFrame, asked: DataFrame) -> DataFrame:
    """`(query_id, _target, term, df, idf, avgdl)`, the statistics being those of the query's own target."""
    frequency = entries.groupBy("_index", "term").agg(F.count(F.lit(1)).alias("df"))
    # Per index, and over all of them for queries without a target.
    frequency = _and_all(frequency, ["term"], ["df"])
    totals = _and_all(totals, [], ["n", "length"])
    by_target = F.col("_target").eqNullSafe(F.col("_of"))
    weighted = (
        asked.join(frequency.withColumnRenamed("term", "_term"), by_target & (F.col("term") == F.col("_term")))
        .drop("_of", "_term")
        .join(totals, by_target)
    )
    return weighted.select(
        "query_id", "_target", "term", "df", idf(F.col("n"), F.col("df")).alias("idf"), F.try_divide("length", "n").alias("avgdl")
    )


def idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def _and_all(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Sums per `_index`, renamed `_of`, and over all indices under `_of` NULL."""
    columns = [F.col(k) for k in keys]
    grouped = df.groupingSets([[F.col("_index"), *columns], columns], "_index", *keys)
    return grouped.agg(*[F.sum(s).alias(s) for s in sums]).withColumnRenamed("_index", "_of")
