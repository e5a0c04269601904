"""Scans over several tables, layout jobs and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquery.model import source
from docquery.operators import profile
from docquery.plans.inputs import docs, flat
from docquery.session import new_folder
from docquery.sources import layout, scan
from docquery.sources.mapping import conform as to_mapping


def _keyed(spark, sf, name, key, value):
    df = docs(spark, sf, name)
    return df.select("_index", F.col("_id").cast("string").alias("_id"), F.struct(source(key).alias("key"), source(value).alias("amount")).alias("_source"))


def scan_many(spark, sf):
    """Orders, line items and parts as one index; the amounts are numbers here and text there."""
    tables = [
        _keyed(spark, sf, "orders", "o_orderkey", "o_totalprice"),
        _keyed(spark, sf, "lineitem", "l_orderkey", "l_linenumber"),
        _keyed(spark, sf, "part", "p_partkey", "p_brand"),
    ]
    return scan.union(tables).select("_index", source("key").alias("key"), F.regexp_replace(source("amount"), r"\.0$", "").alias("amount"))


def scan_paths(spark, sf):
    """Two folders as one index; each has fields the other lacks."""
    renamed = {}
    for name, key in (("customer", "c_custkey"), ("supplier", "s_suppkey")):
        renamed[name] = f"{new_folder(spark, 'paths')}/{name}.parquet"
        flat(spark, sf, name).withColumnRenamed(key, "number").write.parquet(renamed[name])
    df = scan.scan_many(spark, list(renamed.values()), "number")
    return df.select("_index", "_id", source("c_mktsegment").alias("segment"), source("s_acctbal").alias("balance"))


def scan_qualified(spark, sf):
    """A table named with its database."""
    flat(spark, sf, "customer").createOrReplaceGlobalTempView("docquery_customer")
    df = scan.scan(spark, "global_temp.docquery_customer", "c_custkey", "customer")
    return df.select("_index", "_id", source("c_mktsegment").alias("segment"))


def reindex_upsert(spark, sf):
    """Urgent orders copied, at twice the price, over an index that holds the finished ones."""
    orders = docs(spark, sf, "orders").withColumn("_index", F.lit("kept"))
    copied = layout.reindex(
        orders,
        new_folder(spark, "upsert"),
        "kept",
        source("o_orderpriority") == "1-URGENT",
        lambda df: df.withColumn("_source", F.col("_source").withField("o_totalprice", F.round(source("o_totalprice") * 2, 2))),
        into=orders.filter(source("o_orderstatus") == "F"),
    )
    return copied.select("_index", "_id", source("o_totalprice").alias("price"))


def scan_pattern(spark, sf):
    """All catalog tables of a name pattern."""
    for n, status in enumerate(("F", "O", "P")):
        view = flat(spark, sf, "orders").filter(F.col("o_orderstatus") == status)
        view.createOrReplaceTempView(f"docquery_orders_{n}")
    df = scan.scan_many(spark, "docquery_orders_*", "o_orderkey")
    return df.groupBy("_index").agg(F.count(F.lit(1)).alias("n"), F.min(source("o_orderstatus")).alias("status"))


def alias_scan(spark, sf):
    members = [
        (_keyed(spark, sf, "orders", "o_orderkey", "o_totalprice"), source("amount") > 200000),
        (_keyed(spark, sf, "supplier", "s_suppkey", "s_acctbal"), None),
    ]
    return scan.alias_scan(members, "docquery_money").select("_index", "_id", source("amount").alias("amount"))


def reindex_filter(spark, sf):
    copied = layout.reindex(
        docs(spark, sf, "orders"),
        new_folder(spark, "reindex"),
        "urgent",
        source("o_orderpriority") == "1-URGENT",
        lambda df: df.withColumn("_source", F.col("_source").withField("o_totalprice", F.round(source("o_totalprice") * 2, 2))),
    )
    return copied.select("_index", "_id", source("o_totalprice").alias("price"), source("o_orderdate").alias("placed"))


def clone(spark, sf):
    return layout.clone(spark, f"{sf}/orders.parquet", new_folder(spark, "clone"))


def _split(spark, sf):
    return layout.split(docs(spark, sf, "orders"), 4, 3, new_folder(spark, "split"))


def split_counts(spark, sf):
    return _split(spark, sf).groupBy("_shard").agg(F.count(F.lit(1)).alias("n"), F.sum("_id").alias("ids"))


def shrink_counts(spark, sf):
    small = layout.shrink(_split(spark, sf), 12, 6, new_folder(spark, "shrink"))
    return small.groupBy("_shard").agg(F.count(F.lit(1)).alias("n"), F.sum("_id").alias("ids"))


def routed_counts(spark, sf):
    path = new_folder(spark, "routed")
    events = docs(spark, sf, "events")
    layout.write_routed(events, source("ts"), lambda ts: F.concat(F.lit("events-"), F.date_format(ts, "yyyy.MM.dd")), path)
    return spark.read.parquet(path).groupBy("_index").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("first_id"))


def rollover_docs(spark, sf):
    rolled = layout.rollover(flat(spark, sf, "events").select("ts", "event_id"), "events", ["ts", "event_id"], max_docs=700)
    return rolled.select("_index", "event_id")


def rollover_age(spark, sf):
    events = flat(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    rolled = layout.rollover(events, "events", time=F.col("ts"), max_age="6 hours")
    return rolled.select("_index", "event_id")


def conform(spark, sf):
    mapping = {
        "properties": {
            "c_name": {"type": "text"},
            "since": {"type": "date"},
            "home": {"properties": {"ip": {"type": "ip"}, "visits": {"type": "long"}}},
        }
    }
    df = to_mapping(docs(spark, sf, "customer"), mapping)
    return df.select(
        "_id",
        source("c_name").alias("c_name"),
        source("c_acctbal").alias("c_acctbal"),
        source("since").alias("since"),
        source("home", "ip").alias("ip"),
        source("home", "visits").alias("visits"),
    )


def stats(spark, sf):
    return profile.stats(docs(spark, sf, "events"), deleted=source("event_type") == "error")


def stats_docs(spark, sf):
    return profile.stats(docs(spark, sf, "orders"), ["docs"])


def segments(spark, sf):
    return profile.segments(spark, f"{sf}/orders.parquet").select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "rows")


def disk_usage(spark, sf):
    return profile.disk_usage(docs(spark, sf, "orders"))


def disk_usage_documents(spark, sf):
    return profile.disk_usage(docs(spark, sf, "documents"))


def search_shards(spark, sf):
    """Rows of one customer segment's search in each shard of a split table."""
    path = new_folder(spark, "shards")
    layout.split(docs(spark, sf, "customer"), 2, 2, path)
    touched = profile.search_shards(spark, path, F.col("_source.c_mktsegment") == "BUILDING")
    return touched.groupBy("_shard").agg(F.sum("rows").alias("rows"))


QUERIES = {
    f.__name__: f
    for f in (
        scan_many, scan_paths, scan_qualified, reindex_upsert, scan_pattern, alias_scan, reindex_filter, clone, split_counts, shrink_counts, routed_counts,
        rollover_docs, rollover_age, conform, stats, stats_docs, segments, disk_usage, disk_usage_documents, search_shards,
    )
}

_SHARD = "CAST(CAST('0x' || substr(md5(CAST({id} AS VARCHAR)), 1, 8) AS BIGINT) % {n} AS INTEGER)"
_WIDTHS = {"BIGINT": 8, "DOUBLE": 8, "TIMESTAMP": 8, "INTEGER": 4}


def _usage(table: str, **fields: str) -> str:
    def size(name: str, kind: str) -> str:
        return f"sum(strlen({name}))" if kind == "VARCHAR" else f"count({name}) * {_WIDTHS[kind]}"

    return " UNION ALL ".join(
        f"""SELECT '{table}' AS _index, '{n}' AS field, count({n}) AS "values", CAST({size(n, k)} AS BIGINT) AS bytes FROM {table}"""
        for n, k in fields.items()
    )


SQL = {
    "scan_many": r"""SELECT 'orders' AS _index, o_orderkey AS key, regexp_replace(CAST(o_totalprice AS VARCHAR), '\.0$', '') AS amount FROM orders
        UNION ALL SELECT 'lineitem', l_orderkey, CAST(l_linenumber AS VARCHAR) FROM lineitem
        UNION ALL SELECT 'part', p_partkey, p_brand FROM part""",
    "scan_paths": """SELECT 'customer' AS _index, c_custkey AS _id, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
        UNION ALL SELECT 'supplier', s_suppkey, NULL, s_acctbal FROM supplier""",
    "scan_qualified": "SELECT 'customer' AS _index, c_custkey AS _id, c_mktsegment AS segment FROM customer",
    "reindex_upsert": """SELECT 'kept' AS _index, o_orderkey AS _id,
        CASE WHEN o_orderpriority = '1-URGENT' THEN round(o_totalprice * 2, 2) ELSE o_totalprice END AS price
        FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderstatus = 'F'""",
    "scan_pattern": """SELECT CASE o_orderstatus WHEN 'F' THEN 'docquery_orders_0' WHEN 'O' THEN 'docquery_orders_1'
        ELSE 'docquery_orders_2' END AS _index, count(*) AS n, o_orderstatus AS status FROM orders GROUP BY o_orderstatus""",
    "alias_scan": """SELECT 'orders' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, o_totalprice AS amount FROM orders
        WHERE o_totalprice > 200000 UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_acctbal FROM supplier""",
    "reindex_filter": """SELECT 'urgent' AS _index, o_orderkey AS _id, round(o_totalprice * 2, 2) AS price, o_orderdate AS placed
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "clone": "SELECT * FROM orders",
    "split_counts": f"""SELECT {_SHARD.format(id='o_orderkey', n=12)} AS _shard, count(*) AS n,
        CAST(sum(o_orderkey) AS BIGINT) AS ids FROM orders GROUP BY ALL""",
    "shrink_counts": f"""SELECT {_SHARD.format(id='o_orderkey', n=2)} AS _shard, count(*) AS n,
        CAST(sum(o_orderkey) AS BIGINT) AS ids FROM orders GROUP BY ALL""",
    "routed_counts": """SELECT 'events-' || strftime(ts, '%Y.%m.%d') AS _index, count(*) AS n, min(event_id) AS first_id
        FROM events GROUP BY ALL""",
    "rollover_docs": """SELECT 'events-' || printf('%06d', (row_number() OVER (ORDER BY ts, event_id) - 1) // 700 + 1)
        AS _index, event_id FROM events""",
    "rollover_age": """SELECT 'events-' || printf('%06d', dense_rank() OVER (ORDER BY time_bucket(INTERVAL 6 HOUR, ts)))
        AS _index, event_id FROM events""",
    "conform": """SELECT c_custkey AS _id, c_name, c_acctbal, CAST(NULL AS VARCHAR) AS since, CAST(NULL AS VARCHAR) AS ip,
        CAST(NULL AS BIGINT) AS visits FROM customer""",
    "stats": """SELECT 'events' AS _index, count(*) FILTER (event_type <> 'error') AS docs,
        count(*) FILTER (event_type = 'error') AS deleted,
        CAST(sum(32 + strlen(event_type) + strlen(props)) AS BIGINT) AS store FROM events""",
    "stats_docs": "SELECT 'orders' AS _index, count(*) AS docs FROM orders",
    "segments": "SELECT 'orders.parquet' AS file, count(*) AS rows FROM orders",
    "disk_usage": _usage(
        "orders", o_orderkey="BIGINT", o_custkey="BIGINT", o_orderstatus="VARCHAR", o_totalprice="DOUBLE",
        o_orderdate="TIMESTAMP", o_orderpriority="VARCHAR",
    ),
    "disk_usage_documents": _usage(
        "documents", doc_id="BIGINT", text="VARCHAR", lang="VARCHAR", source="VARCHAR", n_chars="BIGINT"
    ),
    "search_shards": f"""SELECT {_SHARD.format(id='c_custkey', n=4)} AS _shard, count(*) AS rows FROM customer
        WHERE c_mktsegment = 'BUILDING' GROUP BY ALL""",
}
