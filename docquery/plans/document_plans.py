"""Key lookups, edits and the bulk log."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquery.model import source
from docquery.operators import bulk, documents
from docquery.plans.inputs import (
    CHANGES_SQL,
    LOG_SQL,
    USER,
    action_log,
    changes,
    docs,
    flat,
    log_chunk,
    order_docs,
    users,
)
from docquery.session import materialize, new_folder
from docquery.sources import versions
from docquery.sources.bulk_files import read_bulk, write_bulk
from docquery.sources.layout import forcemerge

ORDER = ("at", "seq")


def _order_rows(df):
    return df.select(
        "_id",
        source("o_custkey").alias("o_custkey"),
        source("o_orderstatus").alias("o_orderstatus"),
        source("o_totalprice").alias("o_totalprice"),
        source("o_orderdate").alias("o_orderdate"),
        source("o_orderpriority").alias("o_orderpriority"),
    )


def _asked(spark, sf):
    """Ids asked for: one per pair of events, half of them twice, some not in the orders."""
    return changes(spark, sf).select("_id", F.col("seq").alias("pos"))


def doc_index(spark, sf):
    return _order_rows(documents.index(docs(spark, sf, "orders"), order_docs(spark, sf), "seq"))


def doc_index_generated_ids(spark, sf):
    """Documents without ids: equal ones get one id."""
    batch = flat(spark, sf, "events").select(F.lit("kinds").alias("_index"), F.struct("event_type", "user_id").alias("_source"))
    return documents.with_ids(batch).groupBy("_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("_source.event_type").alias("event_type"), F.min("_source.user_id").alias("user_id")
    ).drop("_id")


def doc_create(spark, sf):
    return _order_rows(documents.create(docs(spark, sf, "orders"), order_docs(spark, sf), "seq")[0])


def doc_create_conflicts(spark, sf):
    return documents.create(docs(spark, sf, "orders"), order_docs(spark, sf), "seq")[1].select("_id", "seq")


def doc_get(spark, sf):
    return _order_rows(documents.get(docs(spark, sf, "orders"), 1234))


def doc_delete(spark, sf):
    return _order_rows(documents.delete(docs(spark, sf, "orders"), _asked(spark, sf)))


def doc_exists(spark, sf):
    return documents.exists(docs(spark, sf, "orders"), _asked(spark, sf))


def doc_get_source(spark, sf):
    return documents.get_source(docs(spark, sf, "orders"), _asked(spark, sf))


def doc_source_exists(spark, sf):
    """Orders above 100000 have a source, the others none."""
    orders = docs(spark, sf, "orders").withColumn("_source", F.when(source("o_totalprice") > 100000, F.col("_source")))
    return documents.source_exists(orders, _asked(spark, sf))


def doc_update(spark, sf):
    """Events change the price; clicks the status too, to NULL when k is even."""
    k = F.col("k")
    partial = changes(spark, sf).select(
        "_id",
        "seq",
        F.struct(F.when(k % 2 == 1, F.col("kind")).alias("o_orderstatus"), F.col("value").alias("o_totalprice")).alias("_source"),
        F.when(F.col("kind") == "click", F.array(F.lit("o_orderstatus")))
        .otherwise(F.array(F.lit("o_totalprice")))
        .alias("present"),
    )
    return _order_rows(documents.update_doc(docs(spark, sf, "orders"), partial, "seq"))


def doc_update_script(spark, sf):
    return _order_rows(
        documents.update_script(
            docs(spark, sf, "orders"),
            _asked(spark, sf),
            {"o_totalprice": source("o_totalprice") + 1, "o_orderpriority": F.upper(F.substring(source("o_orderpriority"), 3, 3))},
        )
    )


def _both(spark, sf):
    """Orders and customers as one table; they share ids."""
    return (
        docs(spark, sf, "orders").select("_index", "_id", F.struct(source("o_totalprice").alias("amount")).alias("_source"))
        .unionByName(docs(spark, sf, "customer").select("_index", "_id", F.struct(source("c_acctbal").alias("amount")).alias("_source")))
    )


def _asked_of(spark, sf):
    """Each request names its own index; even positions ask the customers."""
    return _asked(spark, sf).withColumn("_index", F.when(F.col("pos") % 2 == 0, "customer").otherwise("orders"))


def _new_of(spark, sf):
    """Documents of both indices."""
    index = F.when(F.col("seq") % 2 == 0, "customer").otherwise("orders")
    return changes(spark, sf).select(index.alias("_index"), "_id", "seq", F.struct(F.col("value").alias("amount")).alias("_source"))


def _amounts(df):
    return df.select("_index", "_id", source("amount").alias("amount"))


def doc_mget(spark, sf):
    return documents.mget(_both(spark, sf), _asked_of(spark, sf)).select("pos", "_index", "_id", "found", source("amount").alias("amount"))


def doc_index_two_indices(spark, sf):
    return _amounts(documents.index(_both(spark, sf), _new_of(spark, sf), "seq"))


def doc_create_two_indices(spark, sf):
    return _amounts(documents.create(_both(spark, sf), _new_of(spark, sf), "seq")[0])


def doc_delete_two_indices(spark, sf):
    return _amounts(documents.delete(_both(spark, sf), _asked_of(spark, sf)))


def doc_exists_two_indices(spark, sf):
    return documents.exists(_both(spark, sf), _asked_of(spark, sf))


def doc_get_source_two_indices(spark, sf):
    return documents.get_source(_both(spark, sf), _asked_of(spark, sf))


def doc_source_exists_two_indices(spark, sf):
    both = _both(spark, sf).withColumn("_source", F.when(source("amount") > 5000, F.col("_source")))
    return documents.source_exists(both, _asked_of(spark, sf))


def doc_update_two_indices(spark, sf):
    return _amounts(documents.update_doc(_both(spark, sf), _new_of(spark, sf), "seq"))


def doc_update_script_two_indices(spark, sf):
    return _amounts(documents.update_script(_both(spark, sf), _asked_of(spark, sf), {"amount": source("amount") + 1}))


def doc_index_absent_ids(spark, sf):
    """Two in three documents have no id; equal ones stay apart by their place."""
    key = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    body = F.struct(F.col("c_mktsegment").alias("kind"), F.col("c_nationkey").cast("long").alias("who"))
    people = flat(spark, sf, "customer").select(F.lit("people").alias("_index"), key.alias("_id"), body.alias("_source"))
    key = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("c"), F.col("user_id").cast("string")))
    body = F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("who"))
    batch = flat(spark, sf, "events").select(
        F.lit("people").alias("_index"), key.alias("_id"), F.col("event_id").alias("seq"), body.alias("_source")
    )
    return documents.index(people, batch, "seq").select("_id", source("kind").alias("kind"), source("who").alias("who"))


def _kinds(spark, sf, key):
    """Events as documents of people, with ids as given by `key`."""
    body = F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("who"))
    return flat(spark, sf, "events").select(F.lit("people").alias("_index"), key.alias("_id"), F.col("event_id").alias("seq"), body.alias("_source"))


def _people(spark, sf, key):
    body = F.struct(F.col("c_mktsegment").alias("kind"), F.col("c_nationkey").cast("long").alias("who"))
    return flat(spark, sf, "customer").select(F.lit("people").alias("_index"), key.alias("_id"), body.alias("_source"))


def doc_index_int_ids(spark, sf):
    """Whole-number ids of 32 bits; two in three documents have none and get one."""
    batch = _kinds(spark, sf, F.when(F.col("event_id") % 3 == 0, F.col("user_id").cast("int")))
    made = documents.index(_people(spark, sf, F.col("c_custkey").cast("int")), batch, "seq")
    return made.select(source("kind").alias("kind"), source("who").alias("who"))


def doc_create_absent_ids(spark, sf):
    """Documents without ids are all created; those with one only where it is new."""
    batch = _kinds(spark, sf, F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("c"), F.col("user_id").cast("string"))))
    table, conflicts = documents.create(_people(spark, sf, F.concat(F.lit("c"), F.col("c_custkey").cast("string"))), batch, "seq")
    out = table.select(F.lit("stored").alias("part"), source("kind").alias("kind"), source("who").alias("who"), F.lit(None).cast("long").alias("seq"))
    return out.unionByName(conflicts.select(F.lit("conflict").alias("part"), source("kind").alias("kind"), source("who").alias("who"), "seq"))


def bulk_items_no_ids(spark, sf):
    """Actions of which a third have no id, on a table that holds a document whose id is empty."""
    body = F.struct(F.col("event_type").alias("kind"))
    held = flat(spark, sf, "events").filter("event_id % 2 = 0").select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("_id"), body.alias("_source"))
    empty = flat(spark, sf, "region").filter("r_regionkey = 0").select(F.lit("").alias("_id"), F.struct(F.col("r_name").alias("kind")).alias("_source"))
    table = held.unionByName(empty).withColumn("_index", F.lit("people"))
    kind = F.col("event_type")
    log = flat(spark, sf, "events").select(
        F.col("event_id").alias("seq"),
        F.when(kind == "error", "delete").when(kind.isin("view", "click"), "update").otherwise("index").alias("action"),
        F.lit("people").alias("_index"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("e"), F.col("event_id").cast("string"))).alias("_id"),
        body.alias("doc"),
    )
    state, items = bulk.apply_bulk(table, log, ("seq",))
    kept = state.filter("_id = ''").select(F.lit(None).cast("long").alias("seq"), F.lit("kept").alias("action"), source("kind").alias("outcome"))
    return items.select("seq", "action", "outcome").unionByName(kept)


def update_by_query_nested(spark, sf):
    """A field of an object, a new field, and a field of a new object, each from the document's own values."""
    body = F.struct(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("who")).alias("order"), F.col("o_totalprice").alias("price"))
    table = flat(spark, sf, "orders").select(F.lit("orders").alias("_index"), F.col("o_orderkey").alias("_id"), body.alias("_source"))
    cheap = source("price") < 100_000
    changed = documents.update_by_query(table, cheap, {"order.status": F.concat(source("order", "status"), F.lit("!")), "double": source("price") * 2, "seen.by": source("order", "who")})
    return changed.select("_id", source("order", "status").alias("status"), source("order", "who").alias("who"), source("double").alias("double"), source("seen", "by").alias("seen_by"))


def doc_update_sparse(spark, sf):
    """Rows without a source, and rows whose only field is NULL, before a batch that has some of their ids."""
    body = F.when(F.col("_id") % 3 > 0, F.struct(F.when(F.col("_id") % 3 == 1, source("amount")).alias("amount")))
    changed = documents.update_doc(_both(spark, sf).withColumn("_source", body), _new_of(spark, sf), "seq")
    return changed.select("_index", "_id", F.col("_source").isNull().alias("bare"), source("amount").alias("amount"))


def _cheap():
    """NULL where the order is finished, so that those rows are never selected."""
    return F.when(source("o_orderstatus") != "F", source("o_totalprice") < 200000)


def delete_by_query(spark, sf):
    kept, _ = documents.delete_by_query(docs(spark, sf, "orders"), _cheap())
    return _order_rows(kept)


def delete_by_query_count(spark, sf):
    return documents.delete_by_query(docs(spark, sf, "orders"), _cheap())[1]


def update_by_query(spark, sf):
    changed = documents.update_by_query(
        docs(spark, sf, "orders"), _cheap(), {"o_totalprice": source("o_totalprice") * 2, "o_orderstatus": F.lit("X")}
    )
    return _order_rows(changed)


def update_by_query_all(spark, sf):
    return _order_rows(documents.update_by_query(docs(spark, sf, "orders"), None, {"o_custkey": source("o_custkey") + 1}))


# -- the log --------------------------------------------------------------------------------------


def _user_rows(df):
    return df.select("_id", *[source(n).alias(n) for n in USER.names])


def _applied(spark, sf):
    return bulk.apply_bulk(users(spark, sf), action_log(spark, sf), ORDER)


def bulk_apply_state(spark, sf):
    return _user_rows(_applied(spark, sf)[0])


def bulk_apply_items(spark, sf):
    return _applied(spark, sf)[1].select("at", "seq", "action", "_id", "outcome")


def _gapped(spark, sf):
    """The log with NULL for every seventh id and for every eleventh time."""
    log = action_log(spark, sf)
    return log.withColumns(
        {"_id": F.when(F.col("seq") % 7 > 0, F.col("_id")), "at": F.when(F.col("seq") % 11 > 0, F.col("at"))}
    )


def bulk_items_nulls(spark, sf):
    """Outcomes by actions without an id or a time: an action without a time comes first."""
    log = _gapped(spark, sf)
    items = bulk.apply_bulk(users(spark, sf), log, ORDER)[1]
    return items.select("at", "seq", "action", F.when(F.col("seq") % 7 > 0, F.col("_id")).alias("_id"), "outcome")


def bulk_new_table(spark, sf):
    """The log applied to nothing, one order column and the default chunks."""
    state, _ = bulk.apply_bulk(None, action_log(spark, sf), ("seq",))
    return _user_rows(state)


def pit_as_of(spark, sf):
    """The users as they stood at the end of 14 January."""
    cutoff = 1705276799999999
    return _user_rows(bulk.as_of(action_log(spark, sf), cutoff, ORDER, users(spark, sf), chunk=log_chunk()))


def bulk_ndjson_roundtrip(spark, sf):
    """The log written as bulk files and read back."""
    path = new_folder(spark, "bulk")
    write_bulk(action_log(spark, sf), path, ORDER)
    doc = F.col("doc")
    return read_bulk(spark, path).select(
        "action",
        "_index",
        F.col("_id").cast("long").alias("_id"),
        F.try_variant_get(doc, "$.last_value", "double").alias("last_value"),
        F.try_variant_get(doc, "$.last_k", "int").alias("last_k"),
        F.coalesce(F.try_variant_get(doc, "$.note", "variant").isNotNull(), F.lit(False)).alias("names_note"),
        F.try_variant_get(doc, "$.note", "string").alias("note"),
    )


def bulk_ndjson_apply(spark, sf):
    """Bulk files parsed once and applied by file and line; ids are text there."""
    path = new_folder(spark, "bulk")
    write_bulk(action_log(spark, sf), path, ORDER)
    log = materialize(read_bulk(spark, path), "parsed")
    stored = users(spark, sf).withColumn("_id", F.col("_id").cast("string"))
    state, _ = bulk.apply_bulk(stored, log, ("file", "seq"))
    return _user_rows(state).withColumn("_id", F.col("_id").cast("long"))


def forcemerge_live(spark, sf):
    path = new_folder(spark, "merged")
    return _user_rows(forcemerge(users(spark, sf), action_log(spark, sf), path, 4, order=ORDER, chunk=log_chunk()))


def _log_parts(spark, sf):
    """The log in three parts: up to 9 January, up to 19 January, and the rest."""
    log, cuts = action_log(spark, sf), [1704844799999999, 1705708799999999]
    edges = [F.col("at") <= cuts[0], (F.col("at") > cuts[0]) & (F.col("at") <= cuts[1]), F.col("at") > cuts[1]]
    return [log.filter(edge) for edge in edges]


def _versioned(spark, sf):
    """The users as a table of versions: four files, and the log in three batches, each given twice."""
    path = new_folder(spark, "versions")
    versions.create_versions(users(spark, sf).repartition(4, "_id"), path)
    opened = []
    for n, part in enumerate(_log_parts(spark, sf)):
        for _ in range(2):
            opened.append(versions.apply_batch(spark, path, part, f"part-{n}", ORDER, chunk=log_chunk()))
    return path, opened


def versions_two_points(spark, sf):
    """Two versions, opened before later batches and read after these and a compaction."""
    path, opened = _versioned(spark, sf)
    versions.compact(spark, path)
    first, second = opened[0].table(), versions.open_version(spark, path, opened[2].number).table()
    return _user_rows(first).withColumn("point", F.lit(1)).unionByName(_user_rows(second).withColumn("point", F.lit(2)))


def versions_compacted(spark, sf):
    path, _ = _versioned(spark, sf)
    return _user_rows(versions.compact(spark, path).table())


def versions_stream(spark, sf):
    """The log as a stream of files, one micro-batch each."""
    path, inbox = new_folder(spark, "versions"), new_folder(spark, "inbox")
    versions.create_versions(users(spark, sf), path)
    for part in _log_parts(spark, sf):
        part.coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(part.schema).parquet(inbox)
        versions.follow(stream, path, "log", f"{path}/stream", ORDER, chunk=log_chunk()).awaitTermination()
    return _user_rows(versions.open_version(spark, path).table())


QUERIES = {
    f.__name__: f
    for f in (
        doc_index, doc_index_generated_ids, doc_create, doc_create_conflicts, doc_get, doc_delete, doc_exists, doc_get_source,
        doc_source_exists, doc_update, doc_update_script, doc_mget, doc_index_two_indices, doc_create_two_indices,
        doc_delete_two_indices, doc_exists_two_indices, doc_get_source_two_indices, doc_source_exists_two_indices,
        doc_update_two_indices, doc_update_script_two_indices, doc_index_absent_ids, doc_index_int_ids, doc_create_absent_ids, bulk_items_no_ids, update_by_query_nested, doc_update_sparse, delete_by_query, delete_by_query_count, update_by_query,
        update_by_query_all, bulk_items_nulls, bulk_apply_state, bulk_apply_items, bulk_new_table, pit_as_of, bulk_ndjson_roundtrip,
        bulk_ndjson_apply, forcemerge_live, versions_two_points, versions_compacted, versions_stream,
    )
}

_COLUMNS = "_id, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_ORDERS = "o_orderkey AS _id, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_NEW = (
    "_id, CAST(NULL AS BIGINT) AS o_custkey, kind AS o_orderstatus, value AS o_totalprice, "
    "CAST(NULL AS TIMESTAMP) AS o_orderdate, 'k' || k AS o_orderpriority"
)


_HAVE = f"""WITH {CHANGES_SQL},
    asked AS (SELECT seq AS pos, _id, value, CASE WHEN seq % 2 = 0 THEN 'customer' ELSE 'orders' END AS _index FROM changes),
    have AS (SELECT 'orders' AS _index, o_orderkey AS _id, o_totalprice AS amount FROM orders
             UNION ALL SELECT 'customer', c_custkey, c_acctbal FROM customer)"""


def _seen(where: str, stored: str = "stored") -> str:
    """What each action finds, by one window over the whole log of an id."""
    return f"""{LOG_SQL},
    seen AS (SELECT log.*, coalesce(last_value(CASE WHEN action IN ('index', 'create') THEN true
                    WHEN action = 'delete' THEN false END IGNORE NULLS)
                OVER (PARTITION BY _id ORDER BY "at", seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                _id IN (SELECT _id FROM {stored})) AS bef
             FROM log WHERE {where})"""


def _state_sql(where: str = "true", stored: str = "stored") -> str:
    """Rows since the last whole document, then the last value of each field among them."""
    return f"""WITH {_seen(where, stored)},
    marked AS (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY "at", seq) AS o,
                      action = 'index' OR (action = 'create' AND NOT bef) AS base FROM seen),
    edge AS (SELECT _id, coalesce(max(o) FILTER (base), 0) AS last_base,
                    coalesce(max(o) FILTER (action = 'delete'), 0) AS last_delete FROM marked GROUP BY _id),
    live AS (SELECT m.*, last_base FROM marked m JOIN edge USING (_id)
             WHERE (base AND o = last_base) OR (action = 'update' AND bef AND o > last_base)),
    val AS (SELECT _id, last_base,
              arg_max({{'v': last_value}}, o) FILTER (base OR kind = 'view') AS v,
              arg_max({{'v': last_k}}, o) FILTER (base OR kind = 'click') AS k,
              arg_max({{'v': note}}, o) FILTER (base OR kind = 'click') AS t
            FROM live GROUP BY _id, last_base),
    ids AS (SELECT _id FROM {stored} UNION SELECT _id FROM edge)
    SELECT ids._id,
           CASE WHEN v IS NULL THEN s.last_value ELSE v.v END AS last_value,
           CASE WHEN k IS NULL THEN s.last_k ELSE k.v END AS last_k,
           CASE WHEN t IS NULL THEN s.note ELSE t.v END AS note
    FROM ids LEFT JOIN edge USING (_id) LEFT JOIN val USING (_id) LEFT JOIN {stored} s USING (_id)
    WHERE edge.last_base > edge.last_delete
       OR (s._id IS NOT NULL AND coalesce(edge.last_base, 0) = 0 AND coalesce(edge.last_delete, 0) = 0)"""


SQL = {
    "doc_index": f"""WITH {CHANGES_SQL},
        fresh AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY _id ORDER BY seq DESC) = 1)
        SELECT {_ORDERS} FROM orders WHERE o_orderkey NOT IN (SELECT _id FROM fresh) UNION ALL SELECT {_NEW} FROM fresh""",
    "doc_index_generated_ids": "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY event_type, user_id",
    "doc_create": f"""WITH {CHANGES_SQL},
        fresh AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY _id ORDER BY seq) = 1)
        SELECT {_ORDERS} FROM orders UNION ALL SELECT {_NEW} FROM fresh WHERE _id NOT IN (SELECT o_orderkey FROM orders)""",
    "doc_create_conflicts": f"""WITH {CHANGES_SQL}
        SELECT _id, seq FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY seq) AS rn FROM changes)
        WHERE rn > 1 OR _id IN (SELECT o_orderkey FROM orders)""",
    "doc_get": f"SELECT {_ORDERS} FROM orders WHERE o_orderkey = 1234",
    "doc_delete": f"WITH {CHANGES_SQL} SELECT {_ORDERS} FROM orders WHERE o_orderkey NOT IN (SELECT _id FROM changes)",
    "doc_exists": f"""WITH {CHANGES_SQL}
        SELECT _id, seq AS pos, _id IN (SELECT o_orderkey FROM orders) AS "exists" FROM changes""",
    "doc_get_source": f"WITH {CHANGES_SQL} SELECT * FROM orders WHERE o_orderkey IN (SELECT _id FROM changes)",
    "doc_source_exists": f"""WITH {CHANGES_SQL}
        SELECT _id, seq AS pos, _id IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 100000) AS "exists" FROM changes""",
    "doc_update": f"""WITH {CHANGES_SQL},
        p AS (SELECT _id, arg_max({{'v': CASE WHEN k % 2 = 1 THEN kind END}}, seq) FILTER (kind = 'click') AS st,
                     arg_max(value, seq) FILTER (kind <> 'click') AS price FROM changes GROUP BY _id)
        SELECT o_orderkey AS _id, o_custkey, CASE WHEN st IS NULL THEN o_orderstatus ELSE st.v END AS o_orderstatus,
               coalesce(price, o_totalprice) AS o_totalprice, o_orderdate, o_orderpriority
        FROM orders LEFT JOIN p ON p._id = o_orderkey""",
    "doc_update_script": f"""WITH {CHANGES_SQL}, hit AS (SELECT DISTINCT _id FROM changes)
        SELECT o_orderkey AS _id, o_custkey, o_orderstatus, CASE WHEN hit._id IS NULL THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice,
               o_orderdate, CASE WHEN hit._id IS NULL THEN o_orderpriority ELSE upper(substr(o_orderpriority, 3, 3)) END AS o_orderpriority
        FROM orders LEFT JOIN hit ON hit._id = o_orderkey""",
    "doc_index_two_indices": f"""{_HAVE}
        SELECT _index, _id, amount FROM have ANTI JOIN asked USING (_index, _id) UNION ALL SELECT _index, _id, value FROM asked""",
    "doc_create_two_indices": f"""{_HAVE}
        SELECT _index, _id, amount FROM have UNION ALL SELECT _index, _id, value FROM asked ANTI JOIN have USING (_index, _id)""",
    "doc_delete_two_indices": f"{_HAVE} SELECT _index, _id, amount FROM have ANTI JOIN asked USING (_index, _id)",
    "doc_exists_two_indices": f"""{_HAVE}
        SELECT _index, _id, pos, have.amount IS NOT NULL AS "exists" FROM asked LEFT JOIN have USING (_index, _id)""",
    "doc_get_source_two_indices": f"{_HAVE} SELECT amount FROM have SEMI JOIN asked USING (_index, _id)",
    "doc_source_exists_two_indices": f"""{_HAVE}
        SELECT _index, _id, pos, coalesce(have.amount > 5000, false) AS "exists" FROM asked LEFT JOIN have USING (_index, _id)""",
    "doc_update_two_indices": f"""{_HAVE}
        SELECT _index, _id, coalesce(asked.value, amount) AS amount FROM have LEFT JOIN asked USING (_index, _id)""",
    "doc_update_script_two_indices": f"""{_HAVE}
        SELECT _index, _id, CASE WHEN asked.pos IS NULL THEN amount ELSE amount + 1 END AS amount
        FROM have LEFT JOIN asked USING (_index, _id)""",
    "doc_index_absent_ids": """WITH batch AS (
            SELECT event_id AS seq, event_type AS kind, user_id AS who,
                   CASE WHEN event_id % 3 = 0 THEN 'c' || user_id
                        ELSE sha256('{"_source":{"kind":"' || event_type || '","who":' || user_id || '},"seq":' || event_id || '}') END AS _id
            FROM events),
        latest AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY _id ORDER BY seq DESC) = 1)
        SELECT 'c' || c_custkey AS _id, c_mktsegment AS kind, CAST(c_nationkey AS BIGINT) AS who FROM customer
        WHERE 'c' || c_custkey NOT IN (SELECT _id FROM latest) UNION ALL SELECT _id, kind, who FROM latest""",
    "doc_index_int_ids": """WITH given AS (SELECT event_id AS seq, event_type AS kind, user_id AS who FROM events WHERE event_id % 3 = 0
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
        SELECT kind, who FROM given UNION ALL SELECT event_type, user_id FROM events WHERE event_id % 3 <> 0
        UNION ALL SELECT c_mktsegment, CAST(c_nationkey AS BIGINT) FROM customer WHERE c_custkey NOT IN (SELECT who FROM given)""",
    "doc_create_absent_ids": """WITH given AS (SELECT event_id AS seq, event_type AS kind, user_id AS who,
            row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1 AND user_id NOT IN (SELECT c_custkey FROM customer) AS new
          FROM events WHERE event_id % 3 = 0)
        SELECT 'stored' AS part, kind, who, CAST(NULL AS BIGINT) AS seq FROM given WHERE new
        UNION ALL SELECT 'stored', event_type, user_id, NULL FROM events WHERE event_id % 3 <> 0
        UNION ALL SELECT 'stored', c_mktsegment, CAST(c_nationkey AS BIGINT), NULL FROM customer
        UNION ALL SELECT 'conflict', kind, who, seq FROM given WHERE NOT new""",
    "bulk_items_no_ids": """WITH a AS (SELECT event_id AS seq, event_id % 2 = 0 AND event_id % 3 <> 0 AS had,
            CASE WHEN event_type = 'error' THEN 'delete' WHEN event_type IN ('view', 'click') THEN 'update' ELSE 'index' END AS action FROM events)
        SELECT seq, action, CASE action WHEN 'delete' THEN CASE WHEN had THEN 'deleted' ELSE 'not_found' END
            WHEN 'update' THEN CASE WHEN had THEN 'updated' ELSE 'missing' END ELSE CASE WHEN had THEN 'updated' ELSE 'created' END END AS outcome FROM a
        UNION ALL SELECT NULL, 'kept', r_name FROM region WHERE r_regionkey = 0""",
    "update_by_query_nested": """SELECT o_orderkey AS _id, CASE WHEN o_totalprice < 100000 THEN o_orderstatus || '!' ELSE o_orderstatus END AS status,
        o_custkey AS who, CASE WHEN o_totalprice < 100000 THEN o_totalprice * 2 END AS "double",
        CASE WHEN o_totalprice < 100000 THEN o_custkey END AS seen_by FROM orders""",
    "doc_update_sparse": f"""{_HAVE}
        SELECT _index, _id, _id % 3 = 0 AND asked.pos IS NULL AS bare,
               coalesce(asked.value, CASE WHEN _id % 3 = 1 THEN amount END) AS amount
        FROM have LEFT JOIN asked USING (_index, _id)""",
    "doc_mget": f"""{_HAVE}
        SELECT pos, a._index, a._id, have._id IS NOT NULL AS found, amount FROM asked a LEFT JOIN have USING (_index, _id)""",
    "delete_by_query": f"SELECT {_ORDERS} FROM orders WHERE NOT (o_orderstatus <> 'F' AND o_totalprice < 200000)",
    "delete_by_query_count": "SELECT count(*) AS deleted FROM orders WHERE o_orderstatus <> 'F' AND o_totalprice < 200000",
    "update_by_query": """SELECT o_orderkey AS _id, o_custkey,
        CASE WHEN o_orderstatus <> 'F' AND o_totalprice < 200000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderstatus <> 'F' AND o_totalprice < 200000 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
        o_orderdate, o_orderpriority FROM orders""",
    "update_by_query_all": f"SELECT {_ORDERS.replace('o_custkey', 'o_custkey + 1 AS o_custkey')} FROM orders",
    "bulk_apply_state": _state_sql(),
    "bulk_apply_items": f"""WITH {_seen("true")}
        SELECT "at", seq, action, _id,
          CASE action WHEN 'create' THEN CASE WHEN bef THEN 'conflict' ELSE 'created' END
                      WHEN 'index' THEN CASE WHEN bef THEN 'updated' ELSE 'created' END
                      WHEN 'update' THEN CASE WHEN bef THEN 'updated' ELSE 'missing' END
                      ELSE CASE WHEN bef THEN 'deleted' ELSE 'not_found' END END AS outcome FROM seen""",
    "bulk_items_nulls": f"""WITH {LOG_SQL},
        gapped AS (SELECT CASE WHEN seq % 11 > 0 THEN "at" END AS "at", seq, action, CASE WHEN seq % 7 > 0 THEN _id END AS _id FROM log),
        seen AS (SELECT *, _id IS NOT NULL AND coalesce(last_value(CASE WHEN action IN ('index', 'create') THEN true
                        WHEN action = 'delete' THEN false END IGNORE NULLS)
                    OVER (PARTITION BY _id ORDER BY "at" NULLS FIRST, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    _id IN (SELECT _id FROM stored)) AS bef FROM gapped)
        SELECT "at", seq, action, _id,
          CASE action WHEN 'create' THEN CASE WHEN bef THEN 'conflict' ELSE 'created' END
                      WHEN 'index' THEN CASE WHEN bef THEN 'updated' ELSE 'created' END
                      WHEN 'update' THEN CASE WHEN bef THEN 'updated' ELSE 'missing' END
                      ELSE CASE WHEN bef THEN 'deleted' ELSE 'not_found' END END AS outcome FROM seen""",
    "bulk_new_table": _state_sql(stored="(SELECT * FROM stored WHERE false)"),
    "pit_as_of": _state_sql('"at" <= 1705276799999999'),
    "bulk_ndjson_roundtrip": f"""WITH {LOG_SQL}
        SELECT action, 'users' AS _index, _id,
               CASE WHEN kind NOT IN ('error', 'click') THEN last_value END AS last_value,
               CASE WHEN kind NOT IN ('error', 'view') THEN last_k END AS last_k,
               kind NOT IN ('error', 'view') AS names_note,
               CASE WHEN kind NOT IN ('error', 'view') THEN note END AS note FROM log""",
    "bulk_ndjson_apply": _state_sql(),
    "forcemerge_live": _state_sql(),
    "versions_two_points": " UNION ALL ".join(
        f"""SELECT *, {n} AS point FROM ({_state_sql(f'"at" <= {cut}')})""" for n, cut in ((1, 1704844799999999), (2, 1705708799999999))
    ),
    "versions_compacted": _state_sql(),
    "versions_stream": _state_sql(),
}
