"""Fields and types of schemaless bodies."""

from pyspark.sql import functions as F

from docquery.operators import profile


def _variants(spark, *bodies):
    return spark.createDataFrame([(b,) for b in bodies], "j string").select(F.parse_json("j").alias("_source"))


def test_fields_of_schemaless_bodies(spark):
    df = _variants(
        spark,
        '{"a":1,"b":{"c":"x","d":[1,2.5,null]},"e":null,"f":[],"g":{}}',
        '{"a":{"z":true},"b":{"c":"y","d":3},"l":[{"m":1},{"m":"t"},[{"m":2}]]}',
        '{"a":2,"k.x":1e300}',
        "7",
        "null",
        None,
    )
    assert sorted(map(tuple, profile.variant_fields(df).collect())) == [
        ("a", "long", 2), ("a", "object", 1), ("a.z", "boolean", 1), ("b.c", "text", 2), ("b.d", "double", 3), ("k.x", "double", 1),
        ("l.m", "long", 2), ("l.m", "text", 1),
    ]
    assert profile.variant_fields(df.limit(0)).count() == 0


def test_schemaless_and_typed_indices_together(spark, docs):
    tables = {"a": docs({"1": (5, "x")}, "n int, word string"), "b": _variants(spark, '{"n":"five","word":"y","more":1}')}
    found = {(r["_index"], r["field"]): (r["type"], r["conflict"]) for r in profile.field_caps(tables).collect()}
    assert found == {
        ("a", "n"): ("integer", True), ("b", "n"): ("text", True), ("a", "word"): ("text", False), ("b", "word"): ("text", False), ("b", "more"): ("long", False),
    }
    only = profile.field_caps({"b": tables["b"]}, ["more"], F.try_variant_get("_source", "$.n", "string") == "none")
    assert only.count() == 0
