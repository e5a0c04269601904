"""Key lookups and edits on small tables."""

import pytest
from pyspark.sql import functions as F

from docquery import session
from docquery.functions.predicates import ids, index_filter, match, match_all, source_filter, term
from docquery.model import source
from docquery.operators import documents
from docquery.sources import scan
from docquery.sources.mapping import conform, mapping_of, schema_of


def state(df):
    return {r["_id"]: (None if r["_source"] is None else tuple(r["_source"])) for r in df.collect()}


@pytest.fixture(autouse=True, params=[500_000, 0], ids=["few ids", "many ids"])
def bound(request, monkeypatch):
    """Every edit also where nothing may be broadcast."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", request.param)


@pytest.fixture
def table(docs):
    return docs({"1": (1, "x"), "2": (2, "y"), "3": (3, None)}, "n int, s string")


def batch(spark, *rows):
    return spark.createDataFrame([("posts", *r) for r in rows], "_index string, _id string, seq int, _source struct<n:int,s:string>")


def test_index_replaces_and_last_wins(spark, table):
    out = state(documents.index(table, batch(spark, ("1", 2, (9, "b")), ("1", 1, (8, "a")), ("4", 3, (4, "n"))), "seq"))
    assert out == {"1": (9, "b"), "2": (2, "y"), "3": (3, None), "4": (4, "n")}


def test_create_reports_conflicts(spark, table):
    new, conflicts = documents.create(table, batch(spark, ("1", 1, (9, "b")), ("4", 3, (5, "z")), ("4", 2, (4, "n"))), "seq")
    assert state(new)["4"] == (4, "n") and state(new)["1"] == (1, "x")
    assert sorted((r["_id"], r.seq) for r in conflicts.collect()) == [("1", 1), ("4", 3)]


def test_get_exists_delete(spark, table):
    asked = spark.createDataFrame([("1",), ("9",), ("1",)], "_id string")
    assert state(documents.get(table, "2")) == {"2": (2, "y")}
    assert sorted((r["_id"], r.exists) for r in documents.exists(table, asked).collect()) == [("1", True), ("1", True), ("9", False)]
    assert set(state(documents.delete(table, asked))) == {"2", "3"}
    assert [tuple(r) for r in documents.get_source(table, asked).collect()] == [(1, "x")]
    assert [tuple(r) for r in documents.get_source(table, "3").collect()] == [(3, None)]
    no_source = table.withColumn("_source", F.when(F.col("_id") != "1", F.col("_source")))
    assert {r["_id"]: r.exists for r in documents.source_exists(no_source, asked).collect()} == {"1": False, "9": False}


def test_partial_updates_apply_in_order(spark, table):
    rows = [("1", 2, (None, "b"), ["s"]), ("1", 1, (7, "a"), ["n", "s"]), ("2", 1, (None, None), ["s"]), ("9", 1, (1, None), ["n"])]
    partial = spark.createDataFrame(rows, "_id string, seq int, _source struct<n:int,s:string>, present array<string>")
    assert state(documents.update_doc(table, partial, "seq")) == {"1": (7, "b"), "2": (2, None), "3": (3, None)}


def test_partial_updates_merge_objects(spark, docs):
    table = docs({"1": ((1, 2), "k")}, "o struct<p:int,q:int>, s string")
    partial = spark.createDataFrame([("1", ((None, 5),))], "_id string, _source struct<o:struct<p:int,q:int>>")
    assert state(documents.update_doc(table, partial))["1"] == ((1, 5), "k")


def test_update_script(spark, table):
    asked = spark.createDataFrame([("1",), ("1",)], "_id string")
    assert state(documents.update_script(table, asked, {"n": source("n") + 1})) == {"1": (2, "x"), "2": (2, "y"), "3": (3, None)}


def test_mget_keeps_request_order_and_index(spark, docs, table):
    both = table.unionByName(docs({"1": (10, "c")}, "n int, s string", "comments"))
    asked = spark.createDataFrame([(0, "comments", "1"), (1, "posts", "1"), (2, "comments", "2")], "pos int, _index string, _id string")
    out = documents.mget(both, asked).orderBy("pos").collect()
    assert [(r.found, r["_source"] and r["_source"].n) for r in out] == [(True, 10), (True, 1), (False, None)]


def test_null_predicates_select_nothing(table):
    undecided = source("s") == "x"
    kept, number = documents.delete_by_query(table, undecided)
    assert set(state(kept)) == {"2", "3"} and number.first().deleted == 1
    assert state(documents.update_by_query(table, undecided, {"n": F.lit(0)})) == {"1": (0, "x"), "2": (2, "y"), "3": (3, None)}
    assert state(documents.update_by_query(table, None, {"n": F.lit(0)}))["3"] == (0, None)


def test_generated_ids_are_stable(spark):
    docs = spark.createDataFrame([((1,),), ((1,),), ((2,),)], "_source struct<n:int>")
    first = sorted(r["_id"] for r in documents.with_ids(docs).collect())
    assert first == sorted(r["_id"] for r in documents.with_ids(docs.repartition(3)).collect())
    assert len(set(first)) == 2


def test_predicates(spark, table):
    assert table.filter(match_all()).count() == 3
    assert table.filter(term(source("s"), "x") | ~term(source("n"), 2)).count() == 2
    text = spark.createDataFrame([("A tale, of_two",), ("Étage 2",), (None,), ("",)], "t string")
    assert text.filter(match("t", "TALE nothing")).count() == 1
    assert text.filter(match("t", "étage")).count() == 1
    assert text.filter(match("t", "...")).count() == 0
    assert set(state(ids(table, ["1", "7"]))) == {"1"}
    assert set(state(ids(table, spark.createDataFrame([("2",)], "_id string")))) == {"2"}
    assert index_filter(table, None).count() == 3 and index_filter(table, source("n") > 1).count() == 2
    assert source_filter(table, ["s"]).columns == ["s"] and source_filter(table).columns == ["n", "s"]


def test_an_index_is_required(spark):
    for target in ("", [], "docquery_none_*"):
        with pytest.raises(ValueError):
            scan.scan(spark, target) if target == "" else scan.scan_many(spark, target)
    with pytest.raises(ValueError):
        scan.union([])


def test_union_turns_conflicting_fields_into_text(spark, docs):
    a = docs({"1": (1, 2, ("x",))}, "n int, k int, o struct<p:string>", "a")
    b = docs({"1": ("one", 2**40, ("y", True))}, "n string, k bigint, o struct<p:string,q:boolean>", "b")
    out = scan.union([a, b])
    assert out.schema["_source"].dataType.simpleString() == "struct<n:string,k:bigint,o:struct<p:string,q:boolean>>"
    assert {r["_index"]: r["_source"].n for r in out.collect()} == {"a": "1", "b": "one"}


def test_conform(docs):
    df = docs({"1": (1, ("x",))}, "n bigint, o struct<p:string>")
    mapping = {"properties": {"o": {"properties": {"q": {"type": "ip"}}}, "at": {"type": "date", "format": "epoch_millis"}}}
    out = conform(df, mapping)
    assert out.schema["_source"].dataType.simpleString() == "struct<n:bigint,o:struct<p:string,q:string>,at:string>"
    assert mapping_of(out.schema["_source"].dataType)["properties"]["at"] == {"type": "date", "format": "epoch_millis"}
    assert out.first()["_source"].o.p == "x"
    with pytest.raises(ValueError):
        conform(df, {"properties": {"n": {"type": "text"}}})


def test_mapping_round_trip(spark):
    mapping = {"properties": {"a": {"type": "date", "format": "x"}, "o": {"properties": {"b": {"type": "integer_range"}}}}}
    assert mapping_of(schema_of(mapping)) == mapping
