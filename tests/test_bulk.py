"""The action log against a sequential simulation, and bulk files against a sequential reader."""

import json
import random

import pytest
from pyspark.sql import functions as F

from docquery import session
from docquery.operators import bulk
from docquery.sources.bulk_files import document_json, read_bulk, write_bulk

FIELDS = ("a", "b")
DDL = "seq bigint, action string, _index string, _id string, doc struct<a:int,b:string>, present array<string>"


def random_log(seed: int, n: int):
    """A third of all actions hit one id; gaps in the order; explicit NULLs."""
    rng = random.Random(seed)
    log, seq = [], 0
    for _ in range(n):
        seq += rng.choice([1, 1, 2, 50])
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(12)}"
        action = rng.choice(["index", "create", "update", "update", "delete"])
        body = {"a": rng.choice([None, rng.randrange(9)]), "b": rng.choice([None, f"s{rng.randrange(9)}"])}
        named = [] if action == "delete" else [f for f in FIELDS if rng.random() < 0.6]
        log.append((seq, action, "t", key, tuple(body[f] for f in FIELDS), named))
    return log


def simulate(stored: dict, log: list):
    table, items = {k: dict(v) for k, v in stored.items()}, []
    for seq, action, _, key, body, named in log:
        there, values = key in table, {f: v for f, v in zip(FIELDS, body) if f in named}
        if action == "delete":
            items.append((seq, "deleted" if there else "not_found"))
            table.pop(key, None)
        elif action == "update":
            items.append((seq, "updated" if there else "missing"))
            if there:
                table[key].update(values)
        elif action == "create" and there:
            items.append((seq, "conflict"))
        else:
            items.append((seq, "updated" if there else "created"))
            # A whole document sets every field, the ones it does not name to NULL.
            table[key] = {f: values.get(f) for f in FIELDS}
    return table, items


def masked(log):
    """A whole document holds only what it names."""
    return [
        (s, a, i, k, tuple(v if a in ("update", "delete") or f in named else None for f, v in zip(FIELDS, body)), named)
        for s, a, i, k, body, named in log
    ]


@pytest.mark.parametrize("seed, rows_per_chunk, bound", [(1, 3, 500_000), (2, 20, 0), (3, 10_000, 500_000)])
def test_apply_bulk_equals_simulation(spark, monkeypatch, seed, rows_per_chunk, bound):
    monkeypatch.setattr(session, "BROADCAST_ROWS", bound)
    log = masked(random_log(seed, 600))
    stored = {f"k{n}": {"a": n, "b": f"old{n}"} for n in range(0, 12, 2)} | {"untouched": {"a": 1, "b": None}}
    table = spark.createDataFrame(
        [("t", k, (v["a"], v["b"])) for k, v in stored.items()], "_index string, _id string, _source struct<a:int,b:string>"
    )
    frame = spark.createDataFrame(log, DDL)
    state, items = bulk.apply_bulk(table, frame, chunk=bulk.even_chunks(frame, ["seq"], rows_per_chunk))
    expected, outcomes = simulate(stored, log)
    assert {r["_id"]: r["_source"].asDict() for r in state.collect()} == expected
    assert sorted((r.seq, r.outcome) for r in items.collect()) == outcomes

    empty, _ = bulk.apply_bulk(None, frame)
    assert {r["_id"]: r["_source"].asDict() for r in empty.collect()} == simulate({}, log)[0]
    cutoff = log[300][0]
    frozen = bulk.as_of(frame, cutoff, table=table)
    assert {r["_id"]: r["_source"].asDict() for r in frozen.collect()} == simulate(stored, [x for x in log if x[0] <= cutoff])[0]


@pytest.mark.parametrize("most", [1, 60, 10_000])
def test_only_ids_with_many_actions_are_cut(spark, monkeypatch, most):
    """All ids are cut, the hot one is, or none; also an id that is NULL."""
    monkeypatch.setattr(bulk, "CHUNK", most)
    log = masked(random_log(7, 400))
    frame = spark.createDataFrame(log, DDL)
    table = spark.createDataFrame([("t", "k1", (1, "x"))], "_index string, _id string, _source struct<a:int,b:string>")
    lost = frame.limit(3).select((F.col("seq") + 10**6).alias("seq"), F.lit("update").alias("action"), "_index", F.lit(None).cast("string").alias("_id"), "doc", "present")
    state, items = bulk.apply_bulk(table, frame.unionByName(lost), chunk=F.floor(F.col("seq") / 50))
    expected, outcomes = simulate({"k1": {"a": 1, "b": "x"}}, log)
    assert {r["_id"]: r["_source"].asDict() for r in state.collect()} == expected
    found = sorted((r.seq, r.outcome) for r in items.collect())
    assert found[:-3] == outcomes and [o for _, o in found[-3:]] == ["missing"] * 3
    windows = items._jdf.queryExecution().optimizedPlan().toString().count("Window [")
    assert windows == (1 if most == 10_000 else 2)


def test_without_present_the_filled_fields_count(spark):
    log = spark.createDataFrame(
        [(1, "index", "x", (1, "s")), (2, "update", "x", (None, "t"))], "seq bigint, action string, _id string, doc struct<a:int,b:string>"
    )
    state, _ = bulk.apply_bulk(None, log)
    assert state.first()["_source"].asDict() == {"a": 1, "b": "t"}


def test_new_documents_without_id_get_distinct_ones(spark):
    log = spark.createDataFrame(
        [(1, "index", None, (1,)), (2, "index", None, (1,)), (3, "create", None, (2,))], "seq bigint, action string, _id string, doc struct<a:int>"
    )
    state, items = bulk.apply_bulk(None, log)
    assert state.select("_id").distinct().count() == 3
    assert {r.outcome for r in items.collect()} == {"created"}


def test_nested_fields_merge(spark):
    log = spark.createDataFrame(
        [(1, "index", "x", ((1, 2),)), (2, "update", "x", ((None, 3),))], "seq bigint, action string, _id string, doc struct<o:struct<p:int,q:int>>"
    )
    state, _ = bulk.apply_bulk(None, log)
    assert state.first()["_source"].asDict(True) == {"o": {"p": 1, "q": 3}}


def test_ids_must_have_one_type(spark):
    log = spark.createDataFrame([(1, "index", 5, (1,))], "seq bigint, action string, _id int, doc struct<a:int>")
    table = spark.createDataFrame([("", "5", (1,))], "_index string, _id string, _source struct<a:int>")
    with pytest.raises(ValueError):
        bulk.apply_bulk(table, log)


def test_an_order_without_integers_needs_chunks(spark):
    log = spark.createDataFrame([("a", "index", "x", (1,))], "at string, action string, _id string, doc struct<a:int>")
    with pytest.raises(ValueError):
        bulk.apply_bulk(None, log, ("at",))


# -- files ----------------------------------------------------------------------------------------


def read_sequentially(lines: list[str], default=None):
    out, header, n = [], None, 0
    for n, line in enumerate(filter(str.strip, lines), 1):
        body = json.loads(line)
        if header is None:
            action = next((a for a in ("index", "create", "update", "delete") if isinstance(body.get(a), dict)), None)
            details = body[action] if action else body
            header = (n, action or "index", details.get("_index", default), details.get("_id"))
            if action == "delete":
                out.append((*header, None))
                header = None
        else:
            doc = body.get("doc") if header[1] == "update" else body
            out.append((*header, doc))
            header = None
    return out


ROLES = ['{"index":{}}', '{"delete":{"x":1}}', '{"delete":{}}', '{"delete":{}}', '{"update":{}}', '{"doc":{}}', '{"create":{}}', '{"p":1}']
MIXED = [
    '{"create":{"_id":"oak"}}', '{"height":31.5,"felled":null}', '{"update":{"_id":"elm"}}', '{"doc":{"height":12}}',
    '{"delete":{"_id":"ash"}}', "", '{"index":{"_id":"fir","_index":"nursery"}}', '{"rows":[1,2]}',
    '{"update":{"_index":"nursery","_id":"yew"}}', '{"doc":{"delete":{"_id":"not a header"}}}', '{"delete":{"_id":77}}',
    '{"index":{"_id":12}}', '{"delete":null}', '{"create":{}}', '{"_id":"inside","_index":"own"}',
]


def parsed(spark, path, default=None):
    df = read_bulk(spark, str(path), default).withColumn("doc", F.to_json("doc"))
    return [
        (r.seq, r.action, r["_index"], r["_id"], None if r.doc is None else json.loads(r.doc))
        for r in df.orderBy("file", "seq").collect()
    ]


def as_read(entries):
    return [(n, a, i, None if k is None else str(k), d) for n, a, i, k, d in entries]


@pytest.mark.parametrize("lines", [ROLES, MIXED])
def test_line_roles(spark, tmp_path, lines):
    (tmp_path / "a.ndjson").write_text("\n".join(lines) + "\n")
    assert parsed(spark, tmp_path, "posts") == as_read(read_sequentially(lines, "posts"))


def test_files_are_read_in_blocks(spark, tmp_path):
    rng = random.Random(5)
    lines = []
    for n in range(4000):
        action = rng.choice(["index", "update", "delete", "delete", "create"])
        lines.append(json.dumps({action: {"_id": f"i{n}"}}))
        if action != "delete":
            lines.append(json.dumps(rng.choice([{"doc": {"a": n}}, {"delete": {"a": n}}, {"text": "x" * rng.randrange(200)}])))
    (tmp_path / "a.ndjson").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.ndjson").write_text("\n".join(ROLES))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        out = parsed(spark, tmp_path)
        blocks = spark.read.text(str(tmp_path)).select("_metadata.file_block_start").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert blocks > 10
    assert out == as_read(read_sequentially(lines)) + as_read(read_sequentially(ROLES))


def test_written_files_read_back(spark, tmp_path):
    log = masked(random_log(9, 300))
    write_bulk(spark.createDataFrame(log, DDL).repartition(5), str(tmp_path / "out"))
    expected = [
        (a, i, k, None if a == "delete" else {f: v for f, v in zip(FIELDS, body) if f in named}) for _, a, i, k, body, named in log
    ]
    assert [x[1:] for x in parsed(spark, tmp_path / "out")] == expected


def test_document_json_writes_named_fields_only(spark):
    log = spark.createDataFrame([(1, (1, None), ["b"]), (2, (2, 'q"'), ["a", "b"])], "seq int, doc struct<a:int,b:string>, present array<string>")
    out = [r[0] for r in log.orderBy("seq").select(document_json(log)).collect()]
    assert out == ['{"b":null}', '{"a":2,"b":"q\\""}']


def test_variant_log_applies_with_explicit_nulls(spark, tmp_path):
    lines = [
        '{"index":{"_id":"1"}}', '{"a":1,"b":"x","o":{"p":1}}', '{"update":{"_id":"1"}}', '{"doc":{"b":null,"o":{"q":2}}}',
        '{"update":{"_id":"2"}}', '{"doc":{"a":1}}',
    ]
    (tmp_path / "a.ndjson").write_text("\n".join(lines))
    schema = spark.createDataFrame([], "a int, b string, o struct<p:int,q:int>").schema
    state, items = bulk.apply_bulk(None, read_bulk(spark, str(tmp_path), "t"), ("file", "seq"), schema=schema)
    assert state.first()["_source"].asDict(True) == {"a": 1, "b": None, "o": {"p": 1, "q": 2}}
    assert [r.outcome for r in items.orderBy("seq").collect()] == ["created", "updated", "missing"]


def test_an_early_outlier_does_not_fill_a_chunk(spark):
    log = spark.range(1, 1001).select(F.when(F.col("id") == 1, F.lit(-(10**12))).otherwise(F.col("id") * 3).alias("seq"))
    sizes = [r["count"] for r in log.groupBy(bulk.even_chunks(log, ["seq"], 100)).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 200


def test_many_cuts_keep_the_order(spark):
    log = spark.range(20_000).select((F.col("id") * F.col("id")).alias("seq"))
    for rows in (1, 13, 500):
        at = log.select("seq", bulk.even_chunks(log, ["seq"], rows).alias("chunk")).orderBy("seq").toPandas()["chunk"]
        assert at.is_monotonic_increasing and at.value_counts().max() <= 2 * max(rows, 20_000 // bulk.BOUNDS**2)


def test_misfits_set_nothing_and_a_null_object_clears_its_fields(spark, docs):
    table = docs({"1": (1, (2,)), "2": (1, (2,))}, "n int, o struct<p:int>")
    log = spark.sql("""SELECT * FROM VALUES (1L, 'update', '1', parse_json('{"n":"abc"}')), (2L, 'update', '2', parse_json('{"o":null}'))
        AS t(seq, action, _id, doc)""").withColumn("_index", F.lit("posts"))
    out = {r["_id"]: r["_source"].asDict(recursive=True) for r in bulk.apply_bulk(table, log)[0].collect()}
    assert out == {"1": {"n": 1, "o": {"p": 2}}, "2": {"n": 1, "o": None}}


def test_nested_present_fields_are_written(spark, tmp_path):
    rows = [(1, "update", "a", "1", ((2, None), 3), ["o.p"]), (2, "update", "a", "2", ((None, 5), 3), ["o"]), (3, "update", "a", "3", (None, 3), ["o", "n"])]
    log = spark.createDataFrame(rows, "seq long, action string, _index string, _id string, doc struct<o:struct<p:int,q:int>,n:int>, present array<string>")
    write_bulk(log, str(tmp_path / "nested"))
    out = read_bulk(spark, str(tmp_path / "nested")).select("_id", F.to_json("doc").alias("doc"), "malformed").collect()
    assert {r["_id"]: r.doc for r in out} == {"1": '{"o":{"p":2}}', "2": '{"o":{"p":null,"q":5}}', "3": '{"n":3,"o":null}'}
    assert not any(r.malformed for r in out)


def test_malformed_lines_are_marked(spark, tmp_path):
    lines = ['{"index":{"_id":"1"}}', '{"n":1', '{"index":{"_id":"2"}}', '{"n":2}', '{"index":{"_id"', '{"n":3}']
    (tmp_path / "bad.ndjson").write_text("\n".join(lines))
    out = read_bulk(spark, str(tmp_path / "bad.ndjson")).orderBy("seq").collect()
    assert [r.malformed for r in out] == [True, False, True]
