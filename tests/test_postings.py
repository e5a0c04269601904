"""The kept inverted index against direct searches."""

import re

import pytest
from pyspark.sql import functions as F

from docquery import session
from docquery.functions.text import tokens
from docquery.model import source
from docquery.operators import bulk, postings, search

TEXT = "_source.text"
QUERY = "the dog bird zebra"


@pytest.fixture
def table(docs):
    first = docs({"a": ("The cat, the dog",), "b": ("a dog; a bird",), "c": ("",), "d": (None,), "e": ("bird " * 40,)}, "text string", "x")
    return first.unionByName(docs({"a": ("dog dog",), "z": ("zoo",)}, "text string", "y"))


@pytest.fixture
def log(spark):
    rows = [
        (1, "delete", "x", "a", None),
        (2, "index", "x", "n", ("a new dog the",)),
        (3, "update", "x", "c", ("zebra the bird",)),
        (4, "update", "y", "missing", ("dog",)),
        (5, "index", "y", "a", ("cat",)),
        (6, "create", "x", "e", ("conflict dog",)),
        (7, "index", "x", "gone", ("dog",)),
        (8, "delete", "x", "gone", None),
    ]
    return spark.createDataFrame(rows, "seq int, action string, _index string, _id string, doc struct<text: string>")


@pytest.fixture
def path(spark):
    return session.new_folder(spark, "postings-test")


def hits(df):
    return sorted(tuple(r) for r in df.select("_index", "_id", "_score").collect())


def same_scores(index, table):
    assert hits(postings.scores(index, QUERY)) == hits(search.scores(table, TEXT, QUERY))


def same_answers(spark, index, table):
    same_scores(index, table)
    assert postings.search(index, QUERY, 2).collect() == search.search(table, TEXT, QUERY, size=2).drop("_source").collect()
    queries = spark.createDataFrame([(1, "dog", "y"), (2, "the bird", None), (3, "", None), (4, "zebra zoo", "x")], "query_id int, text string, _index string")
    assert pytest.rows(postings.msearch(index, queries, 2)) == pytest.rows(search.msearch(table, TEXT, queries, 2))
    asked = spark.createDataFrame([("x", "a"), ("y", "a"), ("x", "d"), ("x", "n"), ("x", "absent")], "_index string, _id string")
    assert pytest.rows(postings.explain(index, QUERY, asked)) == pytest.rows(search.explain(table, TEXT, QUERY, asked))
    assert postings.terms_enum(index, "z").collect() == search.terms_enum(table, tokens(source("text")), "z").collect()


@pytest.mark.parametrize("bound", [500_000, 0])
def test_index_follows_a_log(spark, table, log, path, monkeypatch, bound):
    """Also where nothing may be broadcast."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", bound)
    index = postings.build_postings(table, TEXT, path, buckets=4)
    changed, items = bulk.apply_bulk(table, log)
    after = postings.refresh_postings(index, changed, items, TEXT, "one")
    assert after.generations == (0, 1)
    if bound:
        same_answers(spark, after, changed)
    else:
        same_scores(after, changed)
    # The index that was opened before still gives the old answers, also when opened anew at its generation.
    same_scores(index, table)
    same_scores(postings.open_postings(spark, path, generation=0), table)


def test_batches_are_applied_once(spark, table, log, path):
    index = postings.build_postings(table, TEXT, path, buckets=4)
    changed, items = bulk.apply_bulk(table, log)
    # A writer that broke off before its commit leaves folders behind; they are not read, and written over.
    left = table.withColumns({"term": F.lit("dog"), "tf": F.lit(9), "_length": F.lit(9), "bucket": F.lit(0)})
    left.select("_index", "_id", "_length", "term", "tf", "bucket").write.partitionBy("bucket").parquet(f"{path}/entries/generation=1")
    same_scores(postings.open_postings(spark, path), table)
    for _ in range(2):
        after = postings.refresh_postings(index, changed, items, TEXT, "one")
        assert after.generations == (0, 1)
        same_scores(after, changed)
    back = spark.createDataFrame([(1, "index", "x", "a", ("the dog is back",)), (2, "delete", "x", "n", None)], log.schema)
    again, more = bulk.apply_bulk(changed, back)
    third = postings.refresh_postings(after, again, more, TEXT, "two")
    assert third.generations == (0, 1, 2)
    same_scores(third, again)
    whole = postings.compact_postings(third, session.new_folder(spark, "postings-test"))
    same_scores(whole, again)
    assert whole.documents().count() == again.count()


def test_searches_read_only_their_buckets(spark, table, path):
    index = postings.build_postings(table, TEXT, path, buckets=4)
    plan = index.entries(["dog"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\(bucket#\d+ = \d", plan) and re.search(r"PushedFilters: \[[^\]]*EqualTo\(term,dog\)", plan)
    assert "Exchange" not in plan


def test_tables_without_rows_or_index(spark, docs, path):
    empty = postings.build_postings(docs({}, "text string"), TEXT, path, buckets=4)
    assert postings.scores(empty, QUERY).count() == 0 and empty.documents().count() == 0
    bare = docs({"a": ("dog",), "b": ("cat dog",)}, "text string").drop("_index")
    index = postings.build_postings(bare, TEXT, session.new_folder(spark, "postings-test"), buckets=4)
    log = spark.createDataFrame([(1, "delete", "b", None)], "seq int, action string, _id string, doc struct<text: string>")
    changed, items = bulk.apply_bulk(bare, log)
    after = postings.refresh_postings(index, changed, items, TEXT, "one")
    assert [r["_id"] for r in postings.scores(after, "dog").collect()] == ["a"]


def test_hits_among_given_documents(spark, table, path):
    index = postings.build_postings(table, TEXT, path, buckets=4)
    among = table.filter(F.col("_index") == "x")
    assert hits(postings.scores(index, QUERY, among)) == hits(search.scores(table, TEXT, QUERY, F.col("_index") == "x"))


def test_dead_keys_do_not_shuffle_the_entries(spark, table, log, path, monkeypatch):
    """Also where they are somewhat more than other tables that are sent out."""
    index = postings.build_postings(table, TEXT, path, buckets=4)
    changed, items = bulk.apply_bulk(table, log)
    after = postings.refresh_postings(index, changed, items, TEXT, "one")
    monkeypatch.setattr(session, "BROADCAST_ROWS", 2)
    dead = spark.read.parquet(f"{path}/dead/generation=1").count()
    assert 2 < dead <= 2 * postings.DEAD
    live = after._live(after._read("entries"))
    assert re.search(r"Join LeftAnti.*rightHint=\(strategy=broadcast\)", live._jdf.queryExecution().optimizedPlan().toString())
    whole = postings.compact_postings(after, session.new_folder(spark, "postings-test"))
    assert sorted(map(str, whole.documents().collect())) == sorted(map(str, after.documents().collect()))


@pytest.mark.parametrize("open_files", [postings.OPEN, 2])
def test_files_are_in_the_order_of_terms(spark, docs, path, monkeypatch, open_files):
    """Rows are sorted by terms alone, as long as a task may have a file open for each bucket, and the session's setting is as before."""
    monkeypatch.setattr(postings, "OPEN", open_files)
    texts = docs({str(i): (" ".join(f"w{(i * j) % 97} w{j}" for j in range(40)),) for i in range(50)}, "text string")
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    index = postings.build_postings(texts, TEXT, path, buckets=4)
    assert spark.conf.get(key) == before
    rows = index._read("entries").withColumn("file", F.input_file_name())
    terms = rows.filter(F.col("bucket") >= 0).groupBy("file").agg(F.collect_list("term").alias("terms")).collect()
    assert len(terms) > 1 and all(r["terms"] == sorted(r["terms"]) for r in terms)
    assert rows.select("bucket", "file").distinct().groupBy("file").count().filter("count > 1").isEmpty()
    order = postings._dealt(index._read("entries"), 4)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Sort \[term#\d+ ASC" if open_files > 4 else r"Sort \[bucket#\d+ ASC[^]]*, term#\d+ ASC", order)
    same_scores(index, texts)


def test_repeated_words_and_texts_without_words(spark, docs, path):
    index = postings.build_postings(docs({"a": ("b a B a b b",), "c": ("",), "d": (None,), "e": ("...",)}, "text string"), TEXT, path, buckets=4)
    kept = index._read("entries").select("_id", "_length", "term", "tf").collect()
    by_hand = [("a", 6, None, 0), ("a", 6, "a", 2), ("a", 6, "b", 4), ("c", 0, None, 0), ("d", None, None, 0), ("e", 0, None, 0)]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, by_hand))
