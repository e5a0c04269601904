"""Rows without keys or times, descending pages, wide numbers, and untouched rows of large batches."""

from pyspark.sql import functions as F

from docquery import session
from docquery.functions.addresses import load_ip
from docquery.functions.shapes import load_binary, load_int_range
from docquery.operators.documents import delete, index, update_doc
from docquery.operators.paging import page
from docquery.sources.layout import _generation, rollover


def test_pages_return_all_rows_once(spark):
    rows = [(None, 1), (3, 2), (3, 3), (None, 4), (1, 5)]
    df = spark.createDataFrame(rows, "k int, i int")
    for down in (False, True):
        seen, after = [], None
        while found := page(df, [("k", down), "i"], after, 2).collect():
            seen += [tuple(r) for r in found]
            after = seen[-1]
        assert sorted(seen, key=str) == sorted(rows, key=str)


def test_rollover_keeps_rows_without_time(spark):
    df = spark.sql("SELECT timestamp'2024-01-01' AS t UNION ALL SELECT NULL")
    found = rollover(df, "n", time=F.col("t"), max_age="1 day").select("t", "_index").collect()
    assert {(r["t"] is None, r["_index"]) for r in found} == {(True, "n-000001"), (False, "n-000002")}


def test_generations_of_seven_digits_stay_apart(spark):
    names = spark.range(1).select(_generation("n", F.lit(1234567)), _generation("n", F.lit(123456))).first()
    assert tuple(names) == ("n-1234567", "n-123456")


def test_text_with_a_final_newline_is_no_address_and_no_base64(spark):
    row = spark.range(1).select(load_ip(F.lit("1.2.3.4\n")), load_ip(F.lit("::1\n")), load_binary(F.lit("cm3\n"))).first()
    assert tuple(row) == (None, None, None)


def test_update_leaves_other_bodies_alone_at_any_batch_size(spark, monkeypatch):
    table = spark.createDataFrame([("a", None), ("b", {"x": 1}), ("c", {"x": None})], "_id string, _source struct<x:int>")
    partial = spark.createDataFrame([("b", {"x": 2})], "_id string, _source struct<x:int>")
    results = []
    for bound in (500_000, 0):
        monkeypatch.setattr(session, "BROADCAST_ROWS", bound)
        results.append(sorted((r["_id"], r["_source"]) for r in update_doc(table, partial).collect()))
    assert results[0] == results[1]
    assert results[0][0] == ("a", None)


def test_edits_keep_to_the_index_a_batch_names(spark, docs):
    both = docs({"1": (1,)}, "n int", "a").unionByName(docs({"1": (2,)}, "n int", "b"))
    out = index(both, docs({"1": (9,)}, "n int", "a"))
    assert sorted((r["_index"], r["_source"].n) for r in out.collect()) == [("a", 9), ("b", 2)]
    assert [r["_index"] for r in delete(both, docs({"1": (0,)}, "n int", "b")).collect()] == ["a"]


def test_documents_without_id_are_all_kept(spark, docs):
    batch = spark.createDataFrame([("posts", None, 1, (5,)), ("posts", None, 2, (5,)), ("posts", "1", 3, (7,))], "_index string, _id string, seq int, _source struct<n:int>")
    assert sorted(r["_source"].n for r in index(docs({"1": (1,)}, "n int"), batch, "seq").collect()) == [5, 5, 7]
    numbers = batch.withColumn("_id", F.col("_id").cast("long"))
    table = docs({"1": (1,)}, "n int").withColumn("_id", F.col("_id").cast("long"))
    out = index(table, numbers, "seq")
    assert out.schema["_id"].dataType.simpleString() == "bigint"
    assert sorted(r["_source"].n for r in out.collect()) == [5, 5, 7] and not out.filter("_id IS NULL").count()


def test_a_third_member_makes_a_struct_no_range(spark):
    df = spark.createDataFrame([((1, 2, None),), ((1, 2, 3),)], "r struct<gte:long,lte:long,boost:long>")
    out = df.select(load_int_range(F.col("r"), df.schema["r"].dataType).alias("r")).collect()
    assert [r.r and tuple(r.r) for r in out] == [(1, 2), None]
