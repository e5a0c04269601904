"""Typed casting of stored forms derived from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquery.functions.registry import BUILT_IN, CastRegistry, FieldCast
from docquery.functions.shapes import dump_binary
from docquery.functions.stored import as_long
from docquery.model import source
from docquery.operators import codec
from docquery.plans.inputs import texts

DATE = {"type": "date"}
OPTIONAL = {"type": "date", "format": "strict_date_optional_time"}
IP = {"type": "ip"}


def _mapping(**fields) -> dict:
    return {"properties": fields}


def _us(col):
    return F.unix_micros(col.cast("timestamp"))


def _stored_dates(spark, sf):
    """An order date in seven stored forms, by turns: four shapes, two that never load, and NULL."""
    date = F.col("o_orderdate")
    turn = F.col("o_orderkey") % 7
    return texts(spark, sf, "orders").select(
        F.col("o_orderkey").alias("_id"),
        F.when(turn == 0, F.date_format(date, "yyyy-MM-dd"))
        .when(turn == 1, F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(turn == 2, F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(turn == 3, F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(turn == 4, F.lit("1997-02-30"))
        .when(turn == 5, F.concat(F.lit("day "), F.col("o_orderkey").cast("string")))
        .alias("stored"),
    )


def cast_date(spark, sf):
    stored = _stored_dates(spark, sf).select(
        "_id", *[F.col("stored").alias(n) for n in ("plain", "exact", "second", "nanos")]
    )
    mapping = _mapping(
        plain=DATE,
        exact={**DATE, "mode": "exact"},
        second={"type": "date", "format": "strict_date_time_no_millis||strict_date"},
        nanos={"type": "date_nanos", "format": "date_optional_time||strict_date_optional_time_nanos"},
    )
    out = codec.decode(stored, mapping)
    return out.select(
        "_id",
        *[_us(F.col(n)).alias(n) for n in ("plain", "exact", "second", "nanos")],
        *[F.col(f"{n}__raw").alias(f"{n}_raw") for n in ("plain", "exact", "second", "nanos")],
    )


def cast_date_epoch(spark, sf):
    """Schemaless documents: epoch numbers load, the same digits as text do not."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    turn = F.col("event_id") % 4
    body = (
        F.when(turn == 0, F.concat(F.lit('{"at": '), ms.cast("string"), F.lit("}")))
        .when(turn == 1, F.concat(F.lit('{"at": "'), ms.cast("string"), F.lit('"}')))
        .when(turn == 2, F.concat(F.lit('{"at": "'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.lit('"}')))
        .otherwise('{"at": 1.5}')
    )
    docs = texts(spark, sf, "events").select(F.col("event_id").alias("_id"), F.parse_json(body).alias("_source"))
    out = codec.decode(docs, _mapping(at=DATE))
    return out.select("_id", _us(source("at")).alias("at"), source("at__raw").alias("raw"))


def dump_date(spark, sf):
    ts = F.col("ts").cast("timestamp")
    formats = {
        "millis": "strict_date_time",
        "optional": "strict_date_optional_time||epoch_millis",
        "nanos": "strict_date_optional_time_nanos",
        "second": "strict_date_time_no_millis",
        "epoch_ms": "epoch_millis",
        "epoch_s": "epoch_second||strict_date",
        "unsuited": "strict_date",
    }
    typed = texts(spark, sf, "events").select(
        F.col("event_id").alias("_id"), *[ts.alias(n) for n in formats], ts.cast("date").alias("day")
    )
    fields = {n: {"type": "date", "format": f} for n, f in formats.items()}
    # A timestamp under a day-only format keeps its full ISO text.
    fields["unsuited"]["format"] = "strict_year_month_day"
    return codec.encode(typed, _mapping(day=DATE, **fields))


def _stored_ips(spark, sf):
    """Six forms by turns: IPv4, out of range, full and short IPv6, mapped IPv4, no address."""
    e, u = F.col("event_id"), F.col("user_id")
    turn = e % 6
    v4 = F.concat_ws(".", (u % 256).cast("string"), (e % 256).cast("string"), F.lit("0"), F.lit("255"))
    md5 = F.md5(e.cast("string"))
    v6 = F.concat_ws(":", *[F.substring(md5, 4 * i + 1, 4) for i in range(8)])
    short = F.concat(F.lit("FE80::"), F.lower(F.hex(e % 65535 + 1)))
    return texts(spark, sf, "events").select(
        e.alias("_id"),
        F.when(turn == 0, v4)
        .when(turn == 1, F.concat(v4, F.lit("0")))
        .when(turn == 2, v6)
        .when(turn == 3, short)
        .when(turn == 4, F.concat(F.lit("::ffff:"), v4))
        .otherwise(F.concat(F.lit("host "), e.cast("string")))
        .alias("ip"),
    )


def cast_ip(spark, sf):
    out = codec.decode(_stored_ips(spark, sf), _mapping(ip=IP))
    back = codec.encode(out, _mapping(ip=IP)).select("_id", F.col("ip").alias("dumped"))
    return (
        out.select("_id", F.col("ip.version").cast("int").alias("version"), F.hex("ip.bytes").alias("bytes"), F.col("ip__raw").alias("raw"))
        .join(back, "_id")
    )


def cast_binary(spark, sf):
    """Whole texts as Base64; every third one is stored as plain text and does not load."""
    stored = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(dump_binary(F.col("text").cast("binary")))
    docs = texts(spark, sf, "documents").select(F.col("doc_id").alias("_id"), stored.alias("body"))
    out = codec.decode(docs, _mapping(body={"type": "binary"}))
    again = codec.encode(out, _mapping(body={"type": "binary"}))
    return out.select("_id", F.md5("body").alias("loaded"), F.md5("body__raw").alias("raw")).join(
        again.select("_id", F.md5("body").alias("dumped")), "_id"
    )


def _json_docs(spark, sf, *turns):
    """Schemaless documents whose field `f` takes the given JSON texts by turns."""
    body = F.lit(None).cast("string")
    for n, text in enumerate(turns):
        body = F.when(F.col("event_id") % len(turns) == n, text).otherwise(body)
    document = F.concat(F.lit('{"f": '), body, F.lit("}"))
    return texts(spark, sf, "events").select(F.col("event_id").alias("_id"), F.parse_json(document).alias("_source"))


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def cast_geo(spark, sf):
    e = F.col("event_id")
    lat, lon = (e * 17 % 1600) / 10 - 80, (e * 37 % 3600) / 10 - 180
    docs = _json_docs(
        spark, sf,
        _text('{"lat": ', lat, ', "lon": ', lon, "}"),
        _text('"', e, ",", e, '"'),
        _text("[", e, ",", e, "]"),
        _text('{"lat": ', e, "}"),
    )
    out = codec.decode(docs, _mapping(f={"type": "geo_point"}))
    return out.select("_id", source("f", "lat").alias("lat"), source("f", "lon").alias("lon"), source("f__raw").alias("raw"))


def cast_int_range(spark, sf):
    e = F.col("event_id")
    docs = _json_docs(
        spark, sf,
        _text('{"gte": ', e, ', "lte": ', e + 10, "}"),
        _text('{"gte": ', e, '.5, "lte": 9.5}'),
        _text('{"gte": ', e, "}"),
        F.lit("null"),
    )
    out = codec.decode(docs, _mapping(f={"type": "integer_range"}))
    return out.select("_id", source("f", "gte").alias("gte"), source("f", "lte").alias("lte"), source("f__raw").alias("raw"))


def cast_date_range(spark, sf):
    """Typed objects: the second bound is a day, no date, or missing."""
    turn = F.col("o_orderkey") % 3
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    last = F.when(turn == 0, F.date_format(F.date_add("o_orderdate", 30), "yyyy-MM-dd")).when(turn == 1, "soon")
    docs = texts(spark, sf, "orders").select(
        F.col("o_orderkey").alias("_id"), F.struct(F.struct(day.alias("gte"), last.alias("lte")).alias("f")).alias("_source")
    )
    mapping = _mapping(f={"type": "date_range", "format": "strict_date"})
    out = codec.decode(docs, mapping)
    back = codec.encode(out, mapping)
    return out.select(
        "_id",
        source("f", "gte").cast("string").alias("first"),
        source("f", "lte").cast("string").alias("last"),
        source("f__raw").alias("raw"),
    ).join(back.select("_id", source("f", "lte").alias("dumped_last")), "_id")


def _nested(spark, sf):
    """Documents with a list of dates, an object and a list of objects."""
    date = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    ip = F.concat(F.lit("10.0.0."), (F.col("o_custkey") % 512).cast("string"))
    visit = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("on"), F.col("o_custkey").alias("n"))
    body = F.struct(
        F.col("o_orderpriority").alias("title"),
        F.array(date, F.col("o_orderstatus")).alias("dates"),
        F.struct(ip.alias("ip"), F.array(visit, visit).alias("visits")).alias("customer"),
    )
    return texts(spark, sf, "orders").select(F.lit("orders").alias("_index"), F.col("o_orderkey").alias("_id"), body.alias("_source"))


NESTED = _mapping(
    title={"type": "text"}, dates=OPTIONAL, customer=_mapping(ip=IP, visits=_mapping(on={"type": "date", "format": "strict_date"}))
)


def decode_nested(spark, sf):
    out = codec.decode(_nested(spark, sf), NESTED)
    return out.select(
        "_id",
        source("title").alias("title"),
        _us(F.get(source("dates"), F.lit(0))).alias("date0"),
        _us(F.get(source("dates"), F.lit(1))).alias("date1"),
        F.get(source("dates__raw"), F.lit(0)).alias("raw0"),
        F.get(source("dates__raw"), F.lit(1)).alias("raw1"),
        F.hex(source("customer", "ip", "bytes")).alias("ip"),
        source("customer", "ip__raw").alias("ip_raw"),
        _us(F.get(source("customer", "visits"), F.lit(1))["on"]).alias("visit"),
        F.get(source("customer", "visits"), F.lit(1))["n"].alias("visit_n"),
    )


def encode_table(spark, sf):
    """Decoding and encoding gives the stored documents back, values that never loaded included."""
    stored = _nested(spark, sf)
    again = codec.encode(codec.decode(stored, NESTED), NESTED)
    return again.select(
        "_id",
        source("title").alias("title"),
        F.get(source("dates"), F.lit(0)).alias("date0"),
        F.get(source("dates"), F.lit(1)).alias("date1"),
        source("customer", "ip").alias("ip"),
        F.get(source("customer", "visits"), F.lit(0))["on"].alias("visit"),
    )


def found_documents(spark, sf):
    """Documents inside a response: a list of hits per row."""
    one = _nested(spark, sf).select(F.struct("_index", "_id", "_source").alias("hit"))
    responses = one.select(
        F.lit(1).alias("took"), F.struct(F.struct(F.lit(2).alias("value")).alias("total"), F.array("hit", "hit").alias("hits")).alias("hits")
    )
    out = codec.decode(codec.documents_in(responses), NESTED)
    return out.groupBy("_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.hex(source("customer", "ip", "bytes"))).alias("ip"))


def _posts_and_comments(spark, sf):
    """Two indices with the same fields: only posts map `at`, only comments map `ip`."""
    posts = texts(spark, sf, "orders").select(
        F.lit("posts").alias("_index"),
        F.col("o_orderkey").alias("_id"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("at"), F.lit("10.1.2.3").alias("ip")).alias("_source"),
    )
    comments = texts(spark, sf, "customer").select(
        F.lit("comments").alias("_index"),
        F.col("c_custkey").alias("_id"),
        F.struct(F.lit("2024-01-01").alias("at"), F.concat(F.lit("::"), F.hex(F.col("c_custkey") % 60000 + 1)).alias("ip")).alias("_source"),
    )
    return posts.unionByName(comments)


def decode_mixed(spark, sf):
    out = codec.decode_mixed(_posts_and_comments(spark, sf), {"posts": _mapping(at=DATE), "comments": _mapping(ip=IP), "other": None})
    return out.select(
        "_index",
        "_id",
        _us(source("at")).alias("at"),
        source("at__raw").alias("at_raw"),
        F.hex(source("ip", "bytes")).alias("ip"),
        source("ip__raw").alias("ip_raw"),
    )


def encode_log(spark, sf):
    """Typed payloads of an action log; purchases name their own index, whose mapping has no date."""
    kind = F.col("event_type")
    log = texts(spark, sf, "events").select(
        F.col("event_id").alias("seq"),
        F.when(kind == "error", "delete").when(kind.isin("view", "click"), "update").otherwise("index").alias("action"),
        F.when(kind == "purchase", "comments").alias("_index"),
        F.when(
            kind != "error",
            F.struct(
                F.date_trunc("second", F.col("ts")).cast("timestamp").alias("at"),
                F.when(
                    kind == "purchase",
                    F.struct(F.lit(4).cast("tinyint").alias("version"), F.unhex(F.lpad(F.hex(F.col("user_id")), 8, "0")).alias("bytes")),
                ).alias("ip"),
            ),
        ).alias("doc"),
    )
    out = codec.encode_log(log, {"posts": _mapping(at=OPTIONAL), "comments": _mapping(at=OPTIONAL, ip=IP)}, "posts")
    return out.select("seq", "action", "_index", F.col("doc.at").alias("at"), F.col("doc.ip").alias("ip"))


def rename_keys(spark, sf):
    out = codec.rename_keys(_nested(spark, sf), lambda key: key if key.startswith("_") else key.upper())
    return out.select(
        "_id",
        "_source.TITLE",
        F.col("_source.CUSTOMER.IP").alias("IP"),
        F.get(F.col("_source.CUSTOMER.VISITS"), F.lit(0))["N"].alias("N"),
    )


def strip_blank(spark, sf):
    """Blank texts leave lists; an object of blanks and a list of blanks disappear."""
    turn = F.col("event_id") % 4
    word = F.when(turn == 0, "").when(turn == 1, F.col("event_type"))
    body = F.struct(
        word.alias("title"),
        F.array(F.lit("a"), word, F.lit("")).alias("tags"),
        F.array(word, F.lit("")).alias("more"),
        F.struct(word.alias("note"), F.struct(word.alias("deep")).alias("inner")).alias("meta"),
        F.lit(0).alias("zero"),
    )
    docs = texts(spark, sf, "events").select(F.col("event_id").alias("_id"), body.alias("_source"))
    return codec.strip_blank(docs).select("_id", F.to_json("_source").alias("json"))


def cast_report(spark, sf):
    return codec.cast_report(_stored_dates(spark, sf).withColumn("_index", F.lit("orders")), _mapping(stored=DATE))


def _schemaless(spark, sf):
    """Bodies without a schema: lists of dates, of which one in three is none, objects and lists of them, blanks at every level."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    turn = F.col("o_orderkey") % 3
    body = F.concat(
        F.lit('{"at":'), F.when(turn == 0, F.concat(F.lit('"'), day, F.lit('"'))).otherwise(F.concat(F.lit('["'), day, F.lit('",'), turn.cast("string"), F.lit(',"day"]'))),
        F.lit(',"who":'), F.when(turn == 1, F.concat(F.lit('{"on":"'), day, F.lit('","note":""}'))).otherwise(F.concat(F.lit('[{"on":"'), day, F.lit('"},{"on":"x"},7,{"none":[{}]}]'))),
        F.lit(',"empty":{"a":[null,""]},"Id":'), F.col("o_orderkey").cast("string"), F.lit("}"),
    )
    return texts(spark, sf, "orders").select(F.lit("orders").alias("_index"), F.col("o_orderkey").alias("_id"), F.parse_json(body).alias("_source"))


def decode_variant_nested(spark, sf):
    """Lists in schemaless bodies are cast element by element, objects in lists too."""
    out = codec.decode(_schemaless(spark, sf), _mapping(at=DATE, who={"properties": {"on": DATE}}))
    items, who = source("at__items"), source("who__items")
    return out.select(
        "_id",
        _us(source("at")).alias("at"),
        source("at__raw").alias("at_raw"),
        _us(F.get(items, F.lit(0))).alias("item0"),
        _us(F.get(items, F.lit(1))).alias("item1"),
        F.get(source("at__items__raw"), F.lit(2)).alias("raw2"),
        F.size(items).alias("n_items"),
        _us(source("who", "on")).alias("who_on"),
        _us(F.get(who, F.lit(0))["on"]).alias("first_on"),
        F.get(who, F.lit(1))["on__raw"].alias("second_raw"),
        F.get(source("who__items__raw"), F.lit(2)).alias("third_raw"),
    )


def rename_keys_variant(spark, sf):
    out = codec.rename_keys(_schemaless(spark, sf), lambda key: key if key.startswith("_") else key.upper(), F.upper)
    return out.select("_id", F.to_json("_source").alias("json"))


def strip_blank_variant(spark, sf):
    return codec.strip_blank(_schemaless(spark, sf)).select("_id", F.to_json("_source").alias("json"))


def cast_report_nested(spark, sf):
    """Casts inside a list of objects: every object counts."""
    day = F.when(F.col("o_orderkey") % 3 == 0, "never").when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
    visits = F.array(F.struct(day.alias("on")), F.struct(F.lit("2024-01-01").alias("on")))
    stored = texts(spark, sf, "orders").select(
        F.lit("orders").alias("_index"), F.col("o_orderkey").alias("_id"), F.struct(F.when(F.col("o_orderkey") % 5 != 0, visits).alias("visits")).alias("_source")
    )
    return codec.cast_report(stored, _mapping(visits={"properties": {"on": DATE}}))


def custom_cast(spark, sf):
    """A user's cast for prices stored as whole cents, behind the built-in ones."""
    scaled = FieldCast(
        {"type": "scaled_float"},
        lambda col, dtype, field: as_long(col, dtype) / field["scaling_factor"],
        lambda col, dtype, field: F.round(col * field["scaling_factor"]).cast("long"),
        lambda field, dtype: False,
    )
    casts = CastRegistry([scaled], inherit=BUILT_IN)
    mapping = _mapping(price={"type": "scaled_float", "scaling_factor": 100}, at=DATE)
    docs = texts(spark, sf, "orders").select(
        F.col("o_orderkey").alias("_id"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("at"),
    )
    out = codec.decode(docs, mapping, casts)
    back = codec.encode(out, mapping, casts)
    return out.select("_id", F.round("price", 2).alias("price"), _us(F.col("at")).alias("at")).join(
        back.select("_id", F.col("price").alias("cents")), "_id"
    )


QUERIES = {
    f.__name__: f
    for f in (
        cast_date, cast_date_epoch, dump_date, cast_ip, cast_binary, cast_geo, cast_int_range, cast_date_range, decode_nested,
        encode_table, found_documents, decode_mixed, encode_log, rename_keys, strip_blank, cast_report, decode_variant_nested, rename_keys_variant, strip_blank_variant, cast_report_nested, custom_cast,
    )
}

_DATES = r"""
d AS (SELECT o_orderkey AS _id, o_orderkey % 7 AS turn, epoch_us(o_orderdate) AS us,
        CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
             WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
             WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') WHEN 4 THEN '1997-02-30'
             WHEN 5 THEN 'day ' || o_orderkey END AS stored FROM orders)
"""


def _date_columns(**turns: str) -> str:
    return ", ".join(
        f"CASE WHEN turn IN ({t}) THEN us END AS {n}, CASE WHEN turn NOT IN ({t}) THEN stored END AS {n}_raw"
        for n, t in turns.items()
    )


_V4 = "(user_id % 256) || '.' || (event_id % 256) || '.0.255'"
_V4_HEX = "printf('%02X%02X00FF', user_id % 256, event_id % 256)"
_GROUPS = ", ".join(f"substr(m, {4 * i + 1}, 4)" for i in range(8))
_SHORT_GROUPS = ", ".join(f"regexp_replace(substr(m, {4 * i + 1}, 4), '^0{{1,3}}', '')" for i in range(8))
_SHORT = "lower(printf('%x', event_id % 65535 + 1))"
_IP = f"""
d AS (SELECT *, md5(CAST(event_id AS VARCHAR)) AS m, event_id % 6 AS turn FROM events)
SELECT event_id AS _id, CASE turn WHEN 0 THEN 4 WHEN 2 THEN 6 WHEN 3 THEN 6 WHEN 4 THEN 6 END AS version,
  CASE turn WHEN 0 THEN {_V4_HEX} WHEN 2 THEN upper(m)
       WHEN 3 THEN 'FE80' || lpad(upper({_SHORT}), 28, '0') WHEN 4 THEN '00000000000000000000FFFF' || {_V4_HEX} END AS bytes,
  CASE turn WHEN 1 THEN {_V4} || '0' WHEN 5 THEN 'host ' || event_id END AS raw,
  CASE turn WHEN 0 THEN {_V4} WHEN 1 THEN {_V4} || '0' WHEN 2 THEN concat_ws(':', {_SHORT_GROUPS})
       WHEN 3 THEN 'fe80::' || {_SHORT} WHEN 4 THEN '::ffff:' || {_V4} ELSE 'host ' || event_id END AS dumped
FROM d
"""

# Epoch numbers are cut off, not rounded, which is why they come from epoch_us here.
SQL = {
    "cast_date": f"WITH {_DATES} SELECT _id, {_date_columns(plain='0, 1, 2', exact='0, 1', second='0, 2', nanos='0, 2, 3')} FROM d",
    "cast_date_epoch": """SELECT event_id AS _id,
        CASE WHEN event_id % 4 IN (0, 2) THEN epoch_us(ts) // 1000 * 1000 END AS "at",
        CASE event_id % 4 WHEN 1 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR) WHEN 3 THEN '1.5' END AS raw FROM events""",
    "dump_date": """SELECT event_id AS _id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS millis,
        CASE WHEN strftime(ts, '%g') = '000' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
             ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS optional,
        CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
             ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS nanos,
        strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS second, epoch_us(ts) // 1000 AS epoch_ms, epoch_us(ts) // 1000000 AS epoch_s,
        CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
             ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS unsuited,
        strftime(ts, '%Y-%m-%d') AS day FROM events""",
    "cast_ip": f"WITH {_IP}",
    "cast_binary": """SELECT doc_id AS _id, CASE WHEN doc_id % 3 <> 0 THEN md5(text) END AS loaded,
        CASE WHEN doc_id % 3 = 0 THEN md5(text) END AS raw,
        CASE WHEN doc_id % 3 = 0 THEN md5(text) ELSE md5(to_base64(encode(text))) END AS dumped FROM documents""",
    "cast_geo": """SELECT event_id AS _id, CASE WHEN event_id % 4 = 0 THEN (event_id * 17 % 1600) / 10 - 80 END AS lat,
        CASE WHEN event_id % 4 = 0 THEN (event_id * 37 % 3600) / 10 - 180 END AS lon,
        CASE event_id % 4 WHEN 1 THEN event_id || ',' || event_id WHEN 2 THEN '[' || event_id || ',' || event_id || ']'
             WHEN 3 THEN '{"lat":' || event_id || '}' END AS raw FROM events""",
    "cast_int_range": """SELECT event_id AS _id, CASE WHEN event_id % 4 = 0 THEN event_id END AS gte,
        CASE WHEN event_id % 4 = 0 THEN event_id + 10 END AS lte,
        CASE event_id % 4 WHEN 1 THEN '{"gte":' || event_id || '.5,"lte":9.5}' WHEN 2 THEN '{"gte":' || event_id || '}' END AS raw
        FROM events""",
    "cast_date_range": """SELECT o_orderkey AS _id,
        CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS first,
        CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') END AS last,
        CASE o_orderkey % 3 WHEN 1 THEN '{"gte":"' || strftime(o_orderdate, '%Y-%m-%d') || '","lte":"soon"}'
             WHEN 2 THEN '{"gte":"' || strftime(o_orderdate, '%Y-%m-%d') || '"}' END AS raw,
        CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') END AS dumped_last FROM orders""",
    "decode_nested": """SELECT o_orderkey AS _id, o_orderpriority AS title, epoch_us(o_orderdate) AS date0,
        CAST(NULL AS BIGINT) AS date1, CAST(NULL AS VARCHAR) AS raw0, o_orderstatus AS raw1,
        CASE WHEN o_custkey % 512 < 256 THEN printf('0A0000%02X', o_custkey % 512) END AS ip,
        CASE WHEN o_custkey % 512 >= 256 THEN '10.0.0.' || (o_custkey % 512) END AS ip_raw,
        epoch_us(date_trunc('day', o_orderdate)) AS visit, o_custkey AS visit_n FROM orders""",
    "encode_table": """SELECT o_orderkey AS _id, o_orderpriority AS title, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS date0,
        o_orderstatus AS date1, '10.0.0.' || (o_custkey % 512) AS ip, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS visit
        FROM orders""",
    "found_documents": """SELECT o_orderkey AS _id, CAST(2 AS BIGINT) AS n,
        CASE WHEN o_custkey % 512 < 256 THEN printf('0A0000%02X', o_custkey % 512) END AS ip FROM orders""",
    "decode_mixed": """SELECT 'posts' AS _index, o_orderkey AS _id, epoch_us(date_trunc('day', o_orderdate)) AS "at",
          CAST(NULL AS VARCHAR) AS at_raw, CAST(NULL AS VARCHAR) AS ip, '10.1.2.3' AS ip_raw FROM orders
        UNION ALL SELECT 'comments', c_custkey, NULL, '2024-01-01', lpad(printf('%X', c_custkey % 60000 + 1), 32, '0'), NULL FROM customer""",
    "encode_log": """SELECT event_id AS seq,
        CASE WHEN event_type = 'error' THEN 'delete' WHEN event_type IN ('view', 'click') THEN 'update' ELSE 'index' END AS action,
        CASE WHEN event_type = 'purchase' THEN 'comments' ELSE 'posts' END AS _index,
        CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS "at",
        CASE WHEN event_type = 'purchase' THEN (user_id >> 24) || '.' || ((user_id >> 16) & 255) || '.' || ((user_id >> 8) & 255)
             || '.' || (user_id & 255) END AS ip FROM events""",
    "rename_keys": """SELECT o_orderkey AS _id, o_orderpriority AS "TITLE", '10.0.0.' || (o_custkey % 512) AS "IP", o_custkey AS "N" FROM orders""",
    "strip_blank": """SELECT event_id AS _id, CASE WHEN event_id % 4 = 1 THEN
          '{"title":"' || event_type || '","tags":["a","' || event_type || '"],"more":["' || event_type || '"],"meta":{"note":"'
          || event_type || '","inner":{"deep":"' || event_type || '"}},"zero":0}'
        ELSE '{"tags":["a"],"zero":0}' END AS json FROM events""",
    "cast_report": f"""WITH {_DATES} SELECT 'orders' AS _index, 'stored' AS field, count(*) AS rows,
        count(*) FILTER (turn = 6) AS nulls, count(*) FILTER (turn IN (0, 1, 2)) AS "cast",
        count(*) FILTER (turn IN (3, 4, 5)) AS passed, min(stored) FILTER (turn IN (3, 4, 5)) AS sample FROM d""",
    "decode_variant_nested": """WITH d AS (SELECT o_orderkey AS _id, o_orderkey % 3 AS turn, epoch_us(date_trunc('day', o_orderdate)) AS us FROM orders)
        SELECT _id, CASE WHEN turn = 0 THEN us END AS "at", CAST(NULL AS VARCHAR) AS at_raw, CASE WHEN turn <> 0 THEN us END AS item0,
               CASE WHEN turn <> 0 THEN turn * 1000 END AS item1, CASE WHEN turn <> 0 THEN 'day' END AS raw2,
               CASE WHEN turn <> 0 THEN 3 END AS n_items, CASE WHEN turn = 1 THEN us END AS who_on, CASE WHEN turn <> 1 THEN us END AS first_on,
               CASE WHEN turn <> 1 THEN 'x' END AS second_raw, CASE WHEN turn <> 1 THEN '7' END AS third_raw FROM d""",
    "rename_keys_variant": """WITH d AS (SELECT o_orderkey AS _id, o_orderkey % 3 AS turn, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
        SELECT _id, '{"AT":' || CASE WHEN turn = 0 THEN '"' || day || '"' ELSE '["' || day || '",' || turn || ',"day"]' END
            || ',"EMPTY":{"A":[null,""]},"ID":' || _id || ',"WHO":'
            || CASE WHEN turn = 1 THEN '{"NOTE":"","ON":"' || day || '"}' ELSE '[{"ON":"' || day || '"},{"ON":"x"},7,{"NONE":[{}]}]' END || '}' AS json FROM d""",
    "strip_blank_variant": """WITH d AS (SELECT o_orderkey AS _id, o_orderkey % 3 AS turn, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
        SELECT _id, '{"Id":' || _id || ',"at":' || CASE WHEN turn = 0 THEN '"' || day || '"' ELSE '["' || day || '",' || turn || ',"day"]' END
            || ',"who":' || CASE WHEN turn = 1 THEN '{"on":"' || day || '"}' ELSE '[{"on":"' || day || '"},{"on":"x"},7]' END || '}' AS json FROM d""",
    "cast_report_nested": """SELECT 'orders' AS _index, 'visits.on' AS field, count(*) AS rows,
        count(*) FILTER (o_orderkey % 5 <> 0 AND o_orderkey % 3 = 2) AS nulls,
        count(*) FILTER (o_orderkey % 5 <> 0) + count(*) FILTER (o_orderkey % 5 <> 0 AND o_orderkey % 3 = 1) AS "cast",
        count(*) FILTER (o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0) AS passed,
        min('never') FILTER (o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0) AS sample FROM orders""",
    "custom_cast": """SELECT o_orderkey AS _id, round(o_totalprice, 2) AS price, epoch_us(date_trunc('day', o_orderdate)) AS "at",
        CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders""",
}
