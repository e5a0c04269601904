"""The test tables as documents, and the action log and changes derived from `events`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.model import as_documents
from docquery.sources.scan import scan, spread

IDS = {
    "documents": "doc_id",
    "labels": "doc_id",
    "benchmark": "item_id",
    "conversations": ["conv_id", "turn"],
    "events": "event_id",
    "orders": "o_orderkey",
    "lineitem": ["l_orderkey", "l_linenumber"],
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "nation": "n_nationkey",
    "region": "r_regionkey",
    "pages": "page_id",
    "embeddings": "vec_id",
}

USER = T.StructType().add("last_value", T.DoubleType()).add("last_k", T.IntegerType()).add("note", T.StringType())
HOUR = 3_600_000_000  # microseconds


def docs(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return scan(spark, f"{sf}/{name}.parquet", IDS[name])


def flat(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table to be analyzed, spread over all cores however few splits it comes in."""
    return spread(flat(spark, sf, name))


def text_docs(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return as_documents(texts(spark, sf, name), name, IDS[name])


def micros(ntz: Column) -> Column:
    return F.unix_micros(ntz.cast("timestamp"))


def users(spark: SparkSession, sf: str) -> DataFrame:
    """The stored table the log is applied to: suppliers as user documents."""
    body = F.struct(
        F.col("s_acctbal").alias("last_value"), F.col("s_nationkey").alias("last_k"), F.col("s_name").alias("note")
    )
    return flat(spark, sf, "supplier").select(F.lit("users").alias("_index"), F.col("s_suppkey").alias("_id"), body.alias("_source"))


def action_log(spark: SparkSession, sf: str) -> DataFrame:
    """One action per event, ordered by `(at, seq)`; clicks set `note`, to NULL when k is even."""
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    note = F.when(k % 2 == 1, F.concat(F.lit("k"), k.cast("string")))
    action = (
        F.when(kind == "signup", "create").when(kind == "purchase", "index").when(kind == "error", "delete").otherwise("update")
    )
    every = [F.lit(n) for n in USER.names]
    return flat(spark, sf, "events").select(
        micros(F.col("ts")).alias("at"),
        F.col("event_id").alias("seq"),
        action.alias("action"),
        F.lit("users").alias("_index"),
        F.col("user_id").alias("_id"),
        F.struct(F.col("value").alias("last_value"), k.alias("last_k"), note.alias("note")).alias("doc"),
        F.when(kind == "view", F.array(F.lit("last_value")))
        .when(kind == "click", F.array(F.lit("last_k"), F.lit("note")))
        .when(kind == "error", F.array().cast("array<string>"))
        .otherwise(F.array(*every))
        .alias("present"),
    )


def log_chunk() -> Column:
    """The hour of an action."""
    return F.expr(f"at div {HOUR}")


LOG_SQL = """
log AS (
  SELECT epoch_us(ts) AS "at", event_id AS seq, user_id AS _id, value AS last_value,
         CAST(json_extract(props, '$.k') AS INTEGER) AS last_k,
         CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) % 2 = 1
              THEN 'k' || CAST(json_extract(props, '$.k') AS VARCHAR) END AS note,
         event_type AS kind,
         CASE event_type WHEN 'signup' THEN 'create' WHEN 'purchase' THEN 'index'
                         WHEN 'error' THEN 'delete' ELSE 'update' END AS action
  FROM events),
stored AS (SELECT s_suppkey AS _id, s_acctbal AS last_value, s_nationkey AS last_k, s_name AS note FROM supplier)
"""


def changes(spark: SparkSession, sf: str) -> DataFrame:
    """Two events per order id, some of them ids the orders do not have; `k` even means status set to NULL."""
    k = F.get_json_object("props", "$.k").cast("int")
    return flat(spark, sf, "events").select(
        (F.floor(F.col("event_id") / 2) * 4).cast("long").alias("_id"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("kind"),
        "value",
        k.alias("k"),
    )


CHANGES_SQL = """
changes AS (
  SELECT CAST((event_id // 2) * 4 AS BIGINT) AS _id, event_id AS seq, event_type AS kind, value,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events)
"""


def order_docs(spark: SparkSession, sf: str) -> DataFrame:
    """The changes as whole order documents: price, status and priority set, the rest NULL."""
    return changes(spark, sf).select(
        F.lit("orders").alias("_index"),
        "_id",
        "seq",
        F.struct(
            F.col("_id").alias("o_orderkey"),
            F.lit(None).cast("long").alias("o_custkey"),
            F.col("kind").alias("o_orderstatus"),
            F.col("value").alias("o_totalprice"),
            F.lit(None).cast("timestamp_ntz").alias("o_orderdate"),
            F.concat(F.lit("k"), F.col("k").cast("string")).alias("o_orderpriority"),
        ).alias("_source"),
    )
