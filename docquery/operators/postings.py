"""A kept inverted index: documents are analyzed once, searched many times, and refreshed from changes.

Everything lies below one folder:

    entries/generation=G/bucket=B   term, _index, _id, _length, tf; bucket -1 has one row per document, without a term
    dead/generation=G               _index, _id: documents whose older rows no longer hold
    totals/generation=G             _index, n, length: what the generation adds to the index's totals, or takes away
    commits                         one row per complete generation

Terms are dealt to buckets by their hash, and a bucket that holds many rows (a frequent
term may own a third of them) is split over files. Files are sorted by term,
so a search reads the row groups of its terms. A row holds unless a later
generation names its document dead.

A generation is there once its commit row is, which is written last. A batch that broke
off is written again over its remains, and a batch that is committed is not applied twice. There
must be one writer at a time; readers see the generations committed when they opened the
index, also while it is refreshed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery import session
from docquery.functions.text import Analyzer, analyzer, query_terms, run_starts
from docquery.operators import search as direct
from docquery.operators.bulk import CHANGED
from docquery.session import bounded_broadcast, materialize, setting

KEYS = ("_index", "_id")
#: Dead keys are broadcast up to so many times the bound of other tables: otherwise all entries would be shuffled by document.
DEAD = 4
#: The bucket of the rows that stand for documents.
ITSELF = -1
#: Up to so many buckets a task that writes keeps their files open side by side.
OPEN = 128

_COMMIT = "generation long, batch string, buckets int, id_type string"
#: Columns of the parts; a part without rows may have no file that tells them.
_PARTS = {
    "entries": "_index string, _id {id}, _length int, term string, tf int, bucket int, generation int",
    "dead": "_index string, _id {id}, generation int",
    "totals": "_index string, n long, length long, generation int",
}


@dataclass(frozen=True)
class Postings:
    """An opened index: a folder and the generations it is read at."""

    spark: SparkSession
    path: str
    generations: tuple[int, ...]
    buckets: int
    id_type: str
    by: str | Analyzer = "standard"

    def entries(self, terms: DataFrame | Sequence[str]) -> DataFrame:
        """Live rows `(_index, _id, _length, term, tf)` of some terms, given as a list or a table with `term`.

        Only their buckets are read.
        """
        rows = self._read("entries")
        if isinstance(terms, DataFrame):
            wanted = terms.select("term", _bucket(F.col("term"), self.buckets).alias("bucket")).distinct()
            rows = rows.join(bounded_broadcast(wanted), ["bucket", "term"], "left_semi")
        else:
            # Two literal filters: one prunes folders, one reaches the reader's statistics.
            numbered = self.spark.range(1).select(F.array(*[_bucket(F.lit(t), self.buckets) for t in terms])).first()[0]
            rows = rows.filter(F.col("bucket").isin(numbered) & F.col("term").isin(list(terms)))
        return self._live(rows).select(*KEYS, "_length", "term", "tf")

    def documents(self) -> DataFrame:
        """Live documents `(_index, _id, _length)`."""
        return self._live(self._read("entries").filter(F.col("bucket") == ITSELF)).select(*KEYS, "_length")

    def totals(self) -> DataFrame:
        """`(_index, n, length)`: a few rows per generation, added up."""
        return self._read("totals").groupBy("_index").agg(F.sum("n").alias("n"), F.sum("length").alias("length"))

    def _read(self, part: str) -> DataFrame:
        folders = [f"{self.path}/{part}/generation={g}" for g in self.generations]
        schema = _PARTS[part].format(id=self.id_type)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{part}").parquet(*folders)

    def _live(self, rows: DataFrame) -> DataFrame:
        if len(self.generations) == 1:
            return rows
        until = self._read("dead").groupBy(*KEYS).agg(F.max("generation").alias("_until"))
        r, d = rows.alias("r"), bounded_broadcast(until, DEAD * session.BROADCAST_ROWS).alias("d")
        return r.join(d, _same("r", "d") & (F.col("r.generation") < F.col("d._until")), "left_anti")


def build_postings(docs: DataFrame, text_col: str, path: str, by: str | Analyzer = "standard", buckets: int = 64) -> Postings:
    """Write the index of a table's texts below a new folder. Several indices may lie in one; `_id` is unique in each."""
    spark = docs.sparkSession
    _write_entries(_counted(docs, text_col, by), f"{path}/entries/generation=0", buckets)
    docs.limit(0).select(*_keys(docs)).write.mode("overwrite").parquet(f"{path}/dead/generation=0")
    first = Postings(spark, path, (0,), buckets, docs.schema["_id"].dataType.simpleString(), by)
    _totals(first.documents()).write.mode("overwrite").parquet(f"{path}/totals/generation=0")
    return _commit(first, 0, "build")


def open_postings(spark: SparkSession, path: str, by: str | Analyzer = "standard", generation: int | None = None) -> Postings:
    """The index as it is now, or as it was at a generation: later refreshes don't show."""
    commits = spark.read.schema(_COMMIT).parquet(f"{path}/commits").collect()  # one row per refresh since the last compaction
    kept = sorted({c["generation"] for c in commits if generation is None or c["generation"] <= generation})
    return Postings(spark, path, tuple(kept), commits[0]["buckets"], commits[0]["id_type"], by)


def refresh_postings(index: Postings, table: DataFrame, items: DataFrame, text_col: str, batch: str) -> Postings:
    """Bring the index up to date with `table', items` of `bulk.apply_bulk`; `batch` names the log.

    Only the documents that an action changed are analyzed and written. Where they
    are few, the table is filtered by their ids and not shuffled.
    """
    commits = index.spark.read.schema(_COMMIT).parquet(f"{index.path}/commits").collect()
    now = open_postings(index.spark, index.path, index.by)
    if batch in {c["batch"] for c in commits}:
        return now
    g = now.generations[-1] + 1
    dead = f"{index.path}/dead/generation={g}"
    hit = items.filter(F.col("outcome").isin(*CHANGED)).select(*_keys(items)).distinct()
    hit.write.mode("overwrite").parquet(dead)
    hit = bounded_broadcast(index.spark.read.schema(hit.schema).parquet(dead))

    def touched(df: DataFrame) -> DataFrame:
        return df.alias("t").join(hit.alias("h"), _same("t", "h"), "left_semi")

    _write_entries(_counted(touched(direct.with_index(table)), text_col, index.by), f"{index.path}/entries/generation={g}", now.buckets)
    after = Postings(index.spark, index.path, (*now.generations, g), now.buckets, now.id_type, index.by)
    new, old = _totals(touched(after.documents())), _totals(touched(now.documents()))
    change = new.unionByName(old.select("_index", (-F.col("n")).alias("n"), (-F.col("length")).alias("length")))
    change.groupBy("_index").agg(F.sum("n").alias("n"), F.sum("length").alias("length")).write.mode("overwrite").parquet(
        f"{index.path}/totals/generation={g}"
    )
    return _commit(after, g, batch)


def compact_postings(index: Postings, path: str) -> Postings:
    """Write the live rows of an index as one generation below a new folder; what reads the old one is not disturbed."""
    rows = index._live(index._read("entries")).select(*KEYS, "_length", "term", "tf", "bucket")
    _write(rows, f"{path}/entries/generation=0", index.buckets)
    rows.limit(0).select(*KEYS).write.mode("overwrite").parquet(f"{path}/dead/generation=0")
    index.totals().write.mode("overwrite").parquet(f"{path}/totals/generation=0")
    return _commit(Postings(index.spark, path, (0,), index.buckets, index.id_type, index.by), 0, "compact")


def scores(index: Postings, text: str, among: DataFrame | None = None) -> DataFrame:
    """`(_index, _id, _score)` of every match, equal to `search.scores` on the documents.

    `among`, a table of ids, narrows the hits but not the statistics.
    """
    terms = query_terms(text, index.by, index.spark)
    entries = materialize(index.entries(terms), "entries")
    asked = index.spark.range(1).select(
        F.lit(0).alias("query_id"), F.lit(None).cast("string").alias("_target"), F.explode(_strings(terms)).alias("term")
    )
    weights = materialize(direct.term_weights(entries, index.totals(), asked), "weights")
    parts = direct.contributions(entries, weights)
    if among is not None:
        kept = bounded_broadcast(direct.with_index(among).select(*KEYS).distinct()).alias("a")
        parts = parts.alias("p").join(kept, _same("p", "a"), "left_semi")
    return parts.groupBy(*KEYS).agg(F.round(F.sum("part"), 6).alias("_score"))


def search(index: Postings, text: str, size: int = 10, among: DataFrame | None = None) -> DataFrame:
    """The top `size` hits `(_index, _id, _score)`, ties to the lower `_id`; join documents for their bodies."""
    return scores(index, text, among).orderBy(F.desc("_score"), "_id", "_index").limit(size)


def msearch(index: Postings, queries: DataFrame, size: int = 10, default_index: str | None = None) -> DataFrame:
    """`search.msearch` from the kept index: no text is read."""
    asked = materialize(direct.query_terms_table(queries, default_index, index.by), "query-terms")
    entries = materialize(index.entries(asked.select("term")), "entries")
    return direct.best_hits(entries, index.totals(), asked, size)


def explain(index: Postings, text: str, ids: DataFrame) -> DataFrame:
    """`search.explain` from the kept index: one row per asked document and query term."""
    terms = query_terms(text, index.by, index.spark)
    keys = ["_index", "_id"] if "_index" in ids.columns else ["_id"]
    asked = ids.select(*keys).distinct()
    entries = materialize(index.entries(terms), "entries")
    # One row per query term, and one of totals.
    df = {r["term"]: r["df"] for r in entries.groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}
    total = index.totals().agg(F.sum("n").alias("n"), F.sum("length").alias("length")).first()
    n, avgdl = total["n"] or 0, total["length"] / total["n"] if total["n"] else 1.0
    stats = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(df.get(t, 0)).cast("long").alias("df")) for t in terms])
    there = index.documents().join(bounded_broadcast(asked), keys, "left_semi")
    rows = asked.join(there, keys, "left").select(*KEYS, "_length", F.inline(stats)).alias("a")
    e = entries.join(bounded_broadcast(asked), keys, "left_semi").alias("e")
    detail = rows.join(e, _same("a", "e") & (F.col("a.term") == F.col("e.term")), "left").select("a.*", F.coalesce("e.tf", F.lit(0)).alias("tf"))
    norm = direct.K1 * (1 - direct.B + direct.B * F.col("_length") / F.lit(avgdl))
    weight = direct.idf(F.lit(n), F.col("df"))
    part = F.coalesce(weight * F.col("tf") / (F.col("tf") + norm), F.lit(0.0))
    return detail.select(
        *KEYS,
        "term",
        (F.col("tf") > 0).alias("matched"),
        F.col("tf").cast("long").alias("tf"),
        "df",
        F.round(weight, 6).alias("idf"),
        F.round(norm, 6).alias("norm"),
        F.round(part, 6).alias("contribution"),
    )


def terms_enum(index: Postings, prefix: str, size: int = 10) -> DataFrame:
    """The first `size` terms of live documents that start with a string; the prefix reaches the reader's statistics."""
    rows = index._read("entries").filter((F.col("bucket") != ITSELF) & F.startswith("term", F.lit(prefix)))
    return index._live(rows).select("term").distinct().orderBy("term").limit(size)


def _counted(docs: DataFrame, text_col: str, by: str | Analyzer) -> DataFrame:
    """`(_index, _id, _length, term, tf)` of every term, and one row without a term per document, row by row."""
    words = direct.with_index(docs).select(*KEYS, F.sort_array(analyzer(by)(F.col(text_col))).alias("_words"))
    itself, none = F.array(F.lit(-1)), F.array().cast("array<int>")
    runs = words.select(
        *KEYS, F.size("_words").alias("_length"), "_words", F.concat(itself, F.coalesce(run_starts(F.col("_words")), none)).alias("_starts")
    )
    # A run's term and length are taken as its row is made: an array of structs of all of them costs more.
    at, after = F.col("_at"), F.get("_starts", F.col("_n") + 1)
    tf = F.when(at < 0, 0).otherwise(F.coalesce(after, F.col("_length")) - at)
    each = runs.select(*KEYS, "_length", "_words", "_starts", F.posexplode_outer("_starts").alias("_n", "_at"))
    return each.select(*KEYS, "_length", F.get("_words", at).alias("term"), tf.alias("tf"))


def _write_entries(rows: DataFrame, path: str, buckets: int) -> None:
    _write(rows.withColumn("bucket", F.when(F.col("term").isNull(), ITSELF).otherwise(_bucket(F.col("term"), buckets))), path, buckets)


def _write(rows: DataFrame, path: str, buckets: int) -> None:
    # With a file open for each bucket it meets, mostly one or two, a task need not bring rows in the order of their buckets.
    with setting(rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", buckets + 1 if _side_by_side(buckets) else 0):
        _dealt(rows, buckets).write.mode("overwrite").partitionBy("bucket").parquet(path)


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows in the order of their files; by terms alone where files are written side by side, which takes less than half the comparing of both."""
    order = ["term"] if _side_by_side(buckets) else ["bucket", "term"]
    return rows.hint("rebalance", "bucket").sortWithinPartitions(*order)


def _side_by_side(buckets: int) -> bool:
    return buckets < OPEN


def _commit(index: Postings, generation: int, batch: str) -> Postings:
    row = index.spark.createDataFrame([(generation, batch, index.buckets, index.id_type)], _COMMIT)
    row.coalesce(1).write.mode("append").parquet(f"{index.path}/commits")
    return index


def _totals(documents: DataFrame) -> DataFrame:
    return documents.groupBy("_index").agg(*direct.totals_of(F.col("_length")))


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _keys(df: DataFrame) -> list[Column]:
    return [F.col("_index") if "_index" in df.columns else F.lit(None).cast("string").alias("_index"), F.col("_id")]


def _same(a: str, b: str) -> Column:
    """Both sides name one document. No index is the index "", as in a log."""
    index = [F.coalesce(f"{side}._index", F.lit("")) for side in (a, b)]
    return (index[0] == index[1]) & (F.col(f"{a}._id") == F.col(f"{b}._id"))


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")
