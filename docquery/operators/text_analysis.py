"""Tokens and term vectors of whole tables.

`id_cols` must identify a text. Offsets, positions and counts are worked out inside
a text's row, by running sums over the lengths of its pieces, so that no text and
no token ever moves; only terms and their counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquery.functions.text import analyzer, term_frequencies, term_runs, token_places, words_and_starts
from docquery.session import bounded_broadcast, join_statistics, materialize


def analyze(df: DataFrame, id_cols: str | Sequence[str], text_col: str, by: str = "standard") -> DataFrame:
    """One row per token: id, `position`, `token`, `start_offset`, `end_offset` (in characters of the text)."""
    if by != "standard":
        raise ValueError("offsets are defined for the standard analyzer")
    ids = _ids(id_cols)
    # The outer form, since for the plain one Spark adds a filter that analyzes the text again.
    placed = df.select(*ids, F.posexplode_outer(words_and_starts(text_col)).alias("position", "_at")).filter("_at.word IS NOT NULL")
    # Of a row per token the rest is compiled, which it is not inside an array.
    word, start = F.col("_at.word"), F.col("_at.start")
    return placed.select(
        *ids, "position", F.lower(word).alias("token"), start.alias("start_offset"), (start + F.length(word)).alias("end_offset")
    )


def termvectors(
    df: DataFrame, id_cols: str | Sequence[str], text_col: str, requests: DataFrame | None = None
) -> DataFrame:
    """Per text and term: `tf`, `positions`, `start_offsets`, `end_offsets`, and the term's and field's statistics.

    `doc_freq` and `total_tf` are the term's over the whole table, `doc_count`,
    `sum_doc_freq` and `sum_total_tf` the field's. `requests`, a table of ids,
    narrows the texts before they are analyzed but not the statistics. For
    documents that are not stored, pass a union of both and request the new ids.
    """
    ids = _ids(id_cols)
    chosen = df if requests is None else df.join(bounded_broadcast(requests.select(*ids).distinct()), ids, "left_semi")
    # A text's terms are gathered inside its row.
    runs = chosen.select(*ids, F.explode_outer(term_runs(token_places(text_col))).alias("_run")).filter("_run IS NOT NULL")
    places = {"positions": "position", "start_offsets": "start_offset", "end_offsets": "end_offset"}
    vectors = runs.select(
        *ids,
        F.get("_run", F.lit(0))["token"].alias("term"),
        F.size("_run").cast("long").alias("tf"),
        *[F.col("_run")[part].alias(name) for name, part in places.items()],
    )
    # Written once; for a whole table the statistics come from the vectors, not from analyzing all texts again.
    vectors = materialize(vectors, "vectors")
    if requests is None:
        opening = F.count_if(F.get("positions", F.lit(0)) == 0)
        terms = vectors.groupBy("term").agg(*_sums(), opening.alias("_texts"))
    else:
        terms = _term_statistics(df, text_col)
    terms = materialize(terms, "terms")
    field = terms.agg(
        F.sum("_texts").alias("doc_count"),
        F.sum(F.when(F.col("term").isNotNull(), F.col("doc_freq"))).alias("sum_doc_freq"),
        F.sum("total_tf").alias("sum_total_tf"),
    ).first()
    joined = join_statistics(vectors, terms.filter("term IS NOT NULL").drop("_texts"), "term", "doc_freq")
    return joined.select(
        *ids,
        "term",
        "tf",
        "positions",
        "start_offsets",
        "end_offsets",
        "doc_freq",
        "total_tf",
        *[F.lit(field[c] or 0).cast("long").alias(c) for c in ("doc_count", "sum_doc_freq", "sum_total_tf")],
    )


def top_terms(
    vectors: DataFrame,
    id_cols: str | Sequence[str],
    size: int = 25,
    tf: tuple[int, int | None] = (1, None),
    doc_freq: tuple[int, int | None] = (1, None),
    length: tuple[int, int | None] = (1, None),
) -> DataFrame:
    """The `size` most telling terms of each text, of the rows of `termvectors`, with `score`: tf times idf.

    `tf`, `doc_freq` and `length` (of the term, in characters) are least and greatest
    values, None for no greatest. idf is that of BM25, scores are rounded to six
    places, ties go to the lower term. Each task keeps at most `size` rows of a text before any moves.
    """
    ids = _ids(id_cols)
    kept = vectors
    for column, (least, most) in ((F.col("tf"), tf), (F.col("doc_freq"), doc_freq), (F.length("term"), length)):
        kept = kept.filter(column >= least)
        if most is not None:
            kept = kept.filter(column <= most)
    idf = F.log(1 + (F.col("doc_count") - F.col("doc_freq") + 0.5) / (F.col("doc_freq") + 0.5))
    scored = kept.withColumn("score", F.round(F.col("tf") * idf, 6))
    best = Window.partitionBy(*ids).orderBy(F.desc("score"), "term")
    return scored.withColumn("_best", F.row_number().over(best)).filter(F.col("_best") <= size).drop("_best")


def mtermvectors(
    tables: dict[str, DataFrame], id_cols: str | Sequence[str], text_col: str, requests: DataFrame, default_index: str | None = None
) -> DataFrame:
    """Term vectors for a list of documents, each possibly in its own index; statistics are the index's own.

    Every request is answered: `found` tells whether the document is there, and one
    that is not, or has no token, gets a row without a term.
    """
    keys = ["_index", *_ids(id_cols)]
    index = F.col("_index") if "_index" in requests.columns else F.lit(None).cast("string")
    asked = requests.withColumn("_index", F.coalesce(index, F.lit(default_index).cast("string")))
    asked = asked.select(*keys).distinct()
    parts, stored = [], []
    for name, table in tables.items():
        own = asked.filter(F.col("_index") == name)
        parts.append(termvectors(table, id_cols, text_col, own).withColumn("_index", F.lit(name)))
        there = table.select(*keys[1:]).join(bounded_broadcast(own.select(*keys[1:])), keys[1:], "left_semi")
        stored.append(there.withColumns({"_index": F.lit(name), "_there": F.lit(True)}))
    answered = asked.join(reduce(DataFrame.unionByName, stored).distinct(), keys, "left")
    vectors = reduce(DataFrame.unionByName, parts)
    joined = answered.join(vectors, keys, "left").withColumn("found", F.col("_there").isNotNull())
    return joined.select(*vectors.columns, "found")


def _term_statistics(df: DataFrame, text_col: str) -> DataFrame:
    """Per term `doc_freq` and `total_tf`, counted inside each text and summed before the shuffle.

    Every text with a token opens with a row without a term; `_texts` counts them.
    """
    counted = df.select(analyzer("standard")(F.col(text_col)).alias("_words")).select(
        term_frequencies(F.col("_words")).alias("_terms")
    )
    itself = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).alias("tf")))
    per_text = counted.select(F.inline_outer(F.concat(itself, F.col("_terms")))).filter("tf IS NOT NULL")
    return per_text.groupBy("term").agg(*_sums(), F.count_if(F.col("term").isNull()).alias("_texts"))


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("doc_freq"), F.sum(F.col("tf").cast("long")).alias("total_tf")]


def _ids(id_cols: str | Sequence[str]) -> list[str]:
    return [id_cols] if isinstance(id_cols, str) else list(id_cols)
