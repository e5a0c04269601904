"""Casting whole documents."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from docquery.functions.registry import BUILT_IN, CastRegistry, FieldCast
from docquery.operators import codec

BEDS = {"properties": {"sown_on": {"type": "date", "format": "strict_date_optional_time"}, "gauge": {"type": "ip"}}}
TOOLS = {"properties": {"gauge": {"type": "ip"}}}
MOMENT = "2031-02-07T16:45:00.250Z"


def us(path):
    return F.unix_micros(path)


@pytest.fixture
def beds(docs):
    bodies = {"1": ("a", MOMENT, "10.20.30.40"), "2": ("b", "soon", "host"), "3": (None, None, None)}
    return docs(bodies, "title string, sown_on string, gauge string")


def test_decode_types_and_passes_through(beds):
    out = {r["_id"]: r["_source"].asDict(True) for r in codec.decode(beds, BEDS).collect()}
    assert out["1"]["sown_on__raw"] is None and out["1"]["sown_on"] is not None
    assert out["1"]["gauge"] == {"version": 4, "bytes": bytearray([10, 20, 30, 40])}
    assert out["2"] == {"title": "b", "sown_on": None, "sown_on__raw": "soon", "gauge": None, "gauge__raw": "host"}
    assert all(v is None for v in out["3"].values())


def test_no_mapping_changes_nothing(beds):
    assert codec.decode(beds, None) is beds
    assert codec.encode(beds, None) is beds
    assert codec.decode_mixed(beds, {"beds": None}) is beds


def test_bare_source(spark):
    bare = spark.createDataFrame([(MOMENT,)], "sown_on string")
    assert codec.decode(bare, BEDS).columns == ["sown_on", "sown_on__raw"]


def test_documents_are_found_at_any_depth(spark):
    hit = "struct<_index:string,_id:string,_source:struct<sown_on:string>>"
    one = ("beds", "1", (MOMENT,))
    bare = spark.createDataFrame([one], "_index string, _id string, _source struct<sown_on:string>")
    search = spark.createDataFrame([(1, ([one, one],))], f"took int, hits struct<hits:array<{hit}>>")
    msearch = spark.createDataFrame([([(([one],),), (([one, one],),)],)], f"responses array<struct<hits:struct<hits:array<{hit}>>>>")
    for df, n in ((bare, 1), (search, 2), (msearch, 3)):
        out = codec.decode(codec.documents_in(df), BEDS)
        assert out.filter("_source.sown_on IS NOT NULL").count() == n
    with pytest.raises(ValueError):
        codec.documents_in(spark.range(1))


def test_each_row_is_cast_by_its_own_index(spark):
    df = spark.createDataFrame(
        [("beds", (MOMENT, "x")), ("tools", ("later", "10.20.30.40")), ("other", ("t", "u"))],
        "_index string, _source struct<sown_on:string,gauge:string>",
    )
    out = {r["_index"]: r["_source"] for r in codec.decode_mixed(df, {"beds": BEDS, "tools": TOOLS}).collect()}
    assert out["beds"].sown_on is not None and out["beds"].gauge__raw == "x"
    assert out["tools"].sown_on__raw == "later" and out["tools"].gauge.version == 4
    assert (out["other"].sown_on__raw, out["other"].gauge__raw) == ("t", "u")


def test_two_casts_of_one_field_get_two_columns(spark):
    df = spark.createDataFrame([("a", ("10.20.30.40",)), ("b", ("2031-02-07",))], "_index string, _source struct<f:string>")
    out = codec.decode_mixed(df, {"a": {"properties": {"f": {"type": "ip"}}}, "b": {"properties": {"f": {"type": "date"}}}})
    found = {r["_index"]: r["_source"] for r in out.collect()}
    assert found["a"].f.version == 4 and found["a"].f__date is None
    assert found["b"].f is None and found["b"].f__date is not None and found["b"].f__raw is None


def test_object_and_value_conflict_is_an_error(spark):
    df = spark.createDataFrame([("a", ("x",))], "_index string, _source struct<f:string>")
    with pytest.raises(ValueError):
        codec.decode_mixed(df, {"a": {"properties": {"f": {"type": "ip"}}}, "b": {"properties": {"f": {"properties": {}}}}})


def test_encode_is_the_inverse(beds):
    again = codec.encode(codec.decode(beds, BEDS), BEDS)
    out = {r["_id"]: r["_source"].asDict() for r in again.collect()}
    assert out["1"] == {"title": "a", "sown_on": "2031-02-07T16:45:00.250Z", "gauge": "10.20.30.40"}
    assert out["2"] == {"title": "b", "sown_on": "soon", "gauge": "host"}
    assert out["3"] == {"title": None, "sown_on": None, "gauge": None}


def test_objects_keep_their_raw_value_beside_them(docs):
    df = docs({"1": ((1.0, None),), "2": ((1.0, 2.0),)}, "at struct<lat:double,lon:double>")
    mapping = {"properties": {"at": {"type": "geo_point"}}}
    out = {r["_id"]: r["_source"] for r in codec.encode(codec.decode(df, mapping), mapping).collect()}
    assert out["2"].at == (1.0, 2.0) and out["2"].at__raw is None
    assert out["1"].at is None and out["1"].at__raw == '{"lat":1.0}'


def test_encode_log(spark):
    moment = dt.datetime(2031, 2, 7, tzinfo=dt.timezone.utc)
    ip = (4, bytearray([10, 20, 30, 40]))
    log = spark.createDataFrame(
        [
            (1, "index", None, (moment, None)),
            (2, "delete", None, None),
            (3, "update", None, (moment, None)),
            (4, "index", "tools", (None, ip)),
        ],
        "seq int, action string, _index string, doc struct<sown_on:timestamp,gauge:struct<version:tinyint,bytes:binary>>",
    )
    out = {r.seq: r for r in codec.encode_log(log, {"beds": BEDS, "tools": TOOLS}, "beds").collect()}
    assert [out[n]["_index"] for n in (1, 2, 3, 4)] == ["beds", "beds", "beds", "tools"]
    assert out[1].doc.sown_on == out[3].doc.sown_on == "2031-02-07T00:00:00Z"
    assert out[2].doc is None and out[4].doc.gauge == "10.20.30.40"


def test_rename_keys_reaches_into_the_source_only(spark):
    df = spark.createDataFrame([("1", (("x",), ["y"]), ("keep",))], "_id string, _source struct<a:struct<b:string>,c:array<string>>, meta struct<d:string>")
    out = codec.rename_keys(df, str.upper)
    assert out.columns == ["_ID", "_SOURCE", "META"]
    hit = codec.rename_keys(df, lambda k: k if k.startswith("_") else k.upper())
    assert hit.schema["_source"].dataType.simpleString() == "struct<A:struct<B:string>,C:array<string>>"
    assert hit.schema["META"].dataType.simpleString() == "struct<d:string>"
    assert hit.first()["_source"]["A"]["B"] == "x"


@pytest.mark.parametrize(
    "ddl, body, expected",
    [
        ("title string, subtitle string, tags array<string>", ("hi", "", []), '{"title":"hi"}'),
        ("v array<string>", (["a", "", None, "b"],), '{"v":["a","b"]}'),
        ("tags array<string>, meta struct<note:string>", (["a", ""], ("",)), '{"tags":["a"]}'),
        ("a array<struct<b:string,c:int>>, z boolean", ([("", None), ("x", 0)], False), '{"a":[{"b":"x","c":0}],"z":false}'),
        ("s string, m map<string,string>", (" ", {"k": "", "l": "x"}), '{"s":" ","m":{"l":"x"}}'),
    ],
)
def test_strip_blank(docs, ddl, body, expected):
    out = codec.strip_blank(docs({"1": body}, ddl)).select(F.to_json("_source")).first()[0]
    assert out == expected


def test_schemaless_documents(spark):
    json = '{"sown_on": 0, "gauge": "10.20.30.40", "meta": {"seen": "2031-02-07", "n": 5}, "tags": ["x"]}'
    mapping = {
        "properties": {
            "sown_on": {"type": "date"},
            "gauge": {"type": "ip"},
            "meta": {"properties": {"seen": {"type": "date"}, "n": {"type": "integer"}}},
        }
    }
    df = spark.createDataFrame([("1", json)], "_id string, j string").select("_id", F.parse_json("j").alias("_source"))
    out = codec.decode(df, mapping)
    row = out.select(
        us("_source.sown_on").alias("at"), "_source.gauge.version", us("_source.meta.seen").alias("seen"), F.to_json("_document").alias("all")
    ).first()
    assert (row.at, row.version, row.seen) == (0, 4, 1928188800000000) and '"tags":["x"]' in row.all


def test_cast_report_counts(beds):
    out = {r.field: r for r in codec.cast_report(beds, BEDS).collect()}
    assert (out["gauge"].rows, out["gauge"].nulls, out["gauge"].cast, out["gauge"].passed, out["gauge"].sample) == (3, 1, 1, 1, "host")


def test_user_cast_by_pandas_udf(docs):
    @F.pandas_udf("double")
    def halved(s):
        return s / 2

    casts = CastRegistry([FieldCast({"type": "half"}, lambda c, t, f: halved(c), lambda c, t, f: c * 2, lambda f, t: False)], inherit=BUILT_IN)
    out = codec.decode(docs({"1": (5.0,)}, "v double"), {"properties": {"v": {"type": "half"}}}, casts)
    assert out.select("_source.v").first()[0] == 2.5


def test_sets_hold_each_value_once(docs):
    mapping = {"properties": {"ips": {"type": "ip", "set": True}}}
    df = docs({"1": (["::1", "0:0::1", "host", "host", "10.20.30.40"],), "2": (["::1"],)}, "ips array<string>")
    decoded = codec.decode(df, mapping)
    out = {r["_id"]: r["_source"] for r in decoded.collect()}
    assert len(out["1"].ips) == 2 and out["1"]["ips__raw"] == ["host"] and out["2"]["ips__raw"] is None
    again = {r["_id"]: r["_source"].ips for r in codec.encode(decoded, mapping).collect()}
    assert again == {"1": ["::1", "10.20.30.40", "host"], "2": ["::1"]}


def test_lists_keep_every_place(docs):
    mapping = {"properties": {"ips": {"type": "ip"}}}
    df = docs({"1": (["::1", "host", None, "::1"],), "2": (None,)}, "ips array<string>")
    decoded = codec.decode(df, mapping)
    raw = {r["_id"]: r["_source"]["ips__raw"] for r in decoded.collect()}
    assert raw == {"1": [None, "host", None, None], "2": None}
    again = {r["_id"]: r["_source"].ips for r in codec.encode(decoded, mapping).collect()}
    assert again == {"1": ["::1", "host", None, "::1"], "2": None}


def test_what_is_no_object_is_kept_as_text(spark):
    df = spark.sql("""SELECT 'i' AS _index, id AS _id, parse_json(body) AS _source FROM VALUES ('1', '{"o":{"at":"2024-01-02"}}'),
        ('2', '{"o":[{"at":"2024-01-02"}]}'), ('3', '{"o":null}'), ('4', '{}'),
        ('5', '{"o":7}'), ('6', '{"o":[{"at":"x"},7]}') AS t(id, body)""")
    mapping = {"properties": {"o": {"properties": {"at": {"type": "date"}}}}}
    out = {r["_id"]: r["_source"] for r in codec.decode(df, mapping).collect()}
    assert out["1"]["o"]["at"] is not None and out["1"]["o__raw"] is None
    assert out["2"]["o"] is None and out["2"]["o__raw"] is None and out["2"]["o__items"][0]["at"] is not None
    assert out["5"]["o__raw"] == "7" and out["6"]["o__items__raw"] == [None, "7"]
    assert all(out[k]["o"] is None and out[k]["o__raw"] is None for k in "34")


DEEP = [
    '{"a":null,"b":null,"c":1}', '{"a":"","b":[{"x":null},{"y":[]}],"c":{"d":{"e":""}}}', '[]', "{}", '{"a":{"b":{}},"k":[{},{},5]}',
    '{"K":"v:\\"x\\",:","L":[1,"",null,2,{"M":""}],"":3,"e":"null"}', '{"z":[[""],[[]],["q"]],"t":"{}","u":"[\\"]"}',
]


def without_blanks(value):
    if isinstance(value, dict):
        return {k: x for k, x in ((k, without_blanks(x)) for k, x in value.items()) if x is not None} or None
    if isinstance(value, list):
        return [x for x in map(without_blanks, value) if x is not None] or None
    return None if value == "" else value


def upper_keys(value):
    if isinstance(value, dict):
        return {k.upper(): upper_keys(x) for k, x in value.items()}
    return [upper_keys(x) for x in value] if isinstance(value, list) else value


@pytest.mark.parametrize("body", DEEP)
def test_schemaless_keys_and_blanks_at_every_level(spark, body):
    df = spark.createDataFrame([("1", body)], "_id string, j string").select("_id", F.parse_json("j").alias("_source"))
    stripped = codec.strip_blank(df).select(F.to_json("_source")).first()[0]
    assert (None if stripped is None else json.loads(stripped)) == without_blanks(json.loads(body))
    renamed = codec.rename_keys(df, lambda k: k if k.startswith("_") else k.upper(), F.upper).select(F.to_json("_source")).first()[0]
    assert json.loads(renamed) == upper_keys(json.loads(body))
    with pytest.raises(ValueError):
        codec.rename_keys(df, str.upper)


def test_map_keys_are_renamed(spark):
    df = spark.createDataFrame([({"k": {"l": "x"}},)], "m map<string,map<string,string>>")
    assert codec.rename_keys(df, str.upper, F.upper).first()["M"] == {"K": {"L": "x"}}
