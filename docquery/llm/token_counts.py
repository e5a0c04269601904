"""Token counts kept up to date by signed changes.

A ledger is a folder of the shared file system. A batch of changes inserts
documents with their counts, deletes some, or revises counts and attributes of
others. What it changes is worked out against the entries so far of the documents
it touches, and written as signed entries: minus the old values, plus the new ones.
Their sums by source, language and tokenizer version are the batch's delta, and
totals are the sum of all deltas. A batch counts from the moment its commit is
written, last; a batch that broke off before is written again over its remains, and
one that was committed changes nothing when it comes again.

Cases: the last change of a document (by `seq`, then the greatest values) in a batch
decides. An insert of a known document revises it; a revision of an unknown one
inserts it; a delete of an unknown one does nothing. Sources, languages and
versions may be NULL and are totals of their own. An insert without an id is
counted and can never be found again; other changes without an id do nothing. A NULL
text has no tokens. Totals of no documents vanish. An empty batch may be committed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.session import join_statistics, materialize

#: Token counts that built-in functions work out, by tokenizer version.
VERSIONS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "words-2": r"\p{L}+|\p{N}+|[^ \t\n\r\p{L}\p{N}]",
}
KEYS = ["source", "lang", "tokenizer"]
_COMMIT = "batch string, changes long"
_ENTRY = "doc_id long, source string, lang string, tokenizer string, docs long, tokens long"


def count_tokens(text: Column, version: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(VERSIONS[version])).cast("long")


def changes(docs: DataFrame, op: str, version: str, tokens: Column | None = None, seq: int = 0) -> DataFrame:
    """One change of kind `op` (insert, delete or revise) per row of `docs` (doc_id, source, lang, text)."""
    counted = F.lit(None).cast("long") if op == "delete" else count_tokens(F.col("text"), version) if tokens is None else tokens
    return docs.select(
        F.lit(seq).alias("seq"), F.lit(op).alias("op"), F.col("doc_id").cast("long").alias("doc_id"), "source", "lang",
        F.lit(version).alias("tokenizer"), counted.alias("tokens"),
    )


class Ledger:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @classmethod
    def create(cls, spark: SparkSession, folder: str) -> Ledger:
        """A new ledger in a folder that nothing was written to."""
        spark.createDataFrame([], _COMMIT).write.parquet(f"{folder}/commits")
        return cls(spark, folder)

    def committed(self) -> list[str]:
        """The names of the batches that count: one row per batch, of which there are few."""
        rows = self.spark.read.schema(_COMMIT).parquet(f"{self.folder}/commits").select("batch").distinct().collect()
        return sorted(r["batch"] for r in rows)

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/{kind}/{batch}" for batch in self.committed()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Apply a batch of changes; False when it was committed before."""
        if batch in self.committed():
            return False
        path = f"{self.folder}/entries/{batch}"
        self._signed(rows).write.mode("overwrite").parquet(path)
        entries = self.spark.read.schema(_ENTRY).parquet(path)
        delta = entries.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        delta.write.mode("overwrite").parquet(f"{self.folder}/deltas/{batch}")
        done = self.spark.createDataFrame([(batch, entries.count())], _COMMIT)
        done.coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
        return True

    def _signed(self, rows: DataFrame) -> DataFrame:
        plus = F.struct("source", "lang", F.lit(1).cast("long").alias("docs"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
        last = (
            rows.filter("doc_id IS NOT NULL")
            .groupBy("doc_id", "tokenizer")
            .agg(F.max(F.struct("seq", "op", "tokens", "source", "lang")).alias("x"))
            .select("doc_id", "tokenizer", "x.*")
        )
        nameless = rows.filter("doc_id IS NULL AND op = 'insert'").select("doc_id", "tokenizer", plus.alias("e")).select("doc_id", "e.source", "e.lang", "tokenizer", "e.docs", "e.tokens")
        new = last.filter("op <> 'delete'").select("doc_id", "tokenizer", plus.alias("e")).select("doc_id", "e.source", "e.lang", "tokenizer", "e.docs", "e.tokens")
        if not self.committed():
            return new.unionByName(nameless)
        touched = last.select(F.col("doc_id").alias("_id"), F.col("tokenizer").alias("_version"))
        held = self._read("entries", _ENTRY).join(
            touched, (F.col("doc_id") == F.col("_id")) & F.col("tokenizer").eqNullSafe(F.col("_version")), "left_semi"
        )
        held = held.groupBy("doc_id", *KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 OR tokens <> 0")
        old = held.select("doc_id", *KEYS, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
        # What a change leaves as it was is no entry.
        signed = old.unionByName(new).groupBy("doc_id", *KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return signed.filter("docs <> 0 OR tokens <> 0").unionByName(nameless).select("doc_id", *KEYS, "docs", "tokens")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens: the sum of all committed deltas."""
        deltas = self._read("deltas", "source string, lang string, tokenizer string, docs long, tokens long")
        summed = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return summed.filter("docs <> 0 OR tokens <> 0")


def copies(docs: DataFrame) -> DataFrame:
    """The documents whose text an earlier id has too."""
    keyed = docs.select("doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    keyed = materialize(keyed, "digests")
    first = materialize(keyed.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1"), "first")
    return join_statistics(keyed, first, "digest", "n").filter("doc_id > first").select("doc_id", "source", "lang")
