"""From raw documents to packed training sequences, as stages that are each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of the documents they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docquery.llm import decontamination, packing, quality, simhash, toxicity
from docquery.llm.queries import tokenizer_files
from docquery.llm.tables import table
from docquery.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are scored as toxic by a model learned from the labelled ones."""
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are scored as poor by a model learned from the labelled ones."""
    return quality.good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of close SimHash fingerprints."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which at least one word in twenty belongs to a benchmark passage."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give every piece of a document its place in a training sequence."""
    return packing.pack(docs, tokenizer_files())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Fingerprints, learned scores and token ids have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
