"""Bulk files: one JSON object per line, a header line and (except for a delete) a payload line."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACTIONS = ("index", "create", "update", "delete")


def read_bulk(spark: SparkSession, path: str, default_index: str | None = None) -> DataFrame:
    """Parse bulk files into an action log `(file, seq, action, _index, _id, doc VARIANT, malformed)`.

    `malformed` marks actions whose header or payload is no JSON. Lines after one
    keep alternating, as if it had been an index action.

    Whether a line is a header depends on all lines before it, but only through
    two numbers: how many lines there are and where the last delete-shaped line
    is, since after such a line a header must follow and every other line just
    alternates. Both are summed up per file block, so a file of any size is read
    in parallel and no window ever holds more than one block.
    """
    lines = (
        spark.read.text(path)
        .filter("trim(value) != ''")
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            "value",
        )
    )
    # `at` only orders lines inside one block, which one task reads from front to back.
    in_block = Window.partitionBy("file", "block").orderBy("at")
    numbered = lines.select(
        "file", "block", "value", F.row_number().over(in_block).cast("long").alias("n"), _deletes(F.col("value")).alias("is_delete")
    )
    blocks = numbered.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("lines"),
        F.max(F.when(F.col("is_delete"), F.col("n"))).alias("last_delete"),
        F.min_by("value", "n").alias("first_line"),
    )
    # One row per block: a few thousand for a file of a terabyte.
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocks.withColumn("base", F.coalesce(F.sum("lines").over(before), F.lit(0)))
        .withColumn("delete_at", F.col("base") + F.col("last_delete"))
        .select(
            "file",
            "block",
            "base",
            F.coalesce(F.max("delete_at").over(before), F.lit(0)).alias("delete_before"),
            F.lead("first_line").over(in_file).alias("next_line"),
        )
    )
    ordered = Window.partitionBy("file", "block").orderBy("n")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    placed = numbered.join(carried, ["file", "block"]).select(
        "file",
        (F.col("base") + F.col("n")).alias("seq"),
        "value",
        F.coalesce(
            F.max(F.when(F.col("is_delete"), F.col("base") + F.col("n"))).over(earlier), F.col("delete_before")
        ).alias("last_delete"),
        F.coalesce(F.lead("value").over(ordered), F.col("next_line")).alias("payload"),
    )
    headers = placed.filter((F.col("seq") - F.col("last_delete") - 1) % 2 == 0)
    return _actions(headers, default_index)


def _deletes(line: Column) -> Column:
    """Whether the line, read as a header, is a delete. Only lines naming the key are parsed."""
    header = F.try_parse_json(line)
    named = [_is_object(_get(header, a)) for a in ACTIONS]
    first = ~named[0] & ~named[1] & ~named[2] & named[3]
    return F.when(F.contains(line, F.lit('"delete"')), first).otherwise(F.lit(False))


def _actions(headers: DataFrame, default_index: str | None) -> DataFrame:
    header = F.col("header")
    action = reduce(
        lambda chain, name: chain.when(_is_object(_get(header, name)), name),
        ACTIONS[1:],
        F.when(_is_object(_get(header, ACTIONS[0])), ACTIONS[0]),
    )
    details = F.coalesce(
        *[F.when((F.col("named") == name), _get(header, name)) for name in ACTIONS], header
    )
    parsed = (
        headers.withColumn("header", F.try_parse_json("value"))
        .withColumn("named", action)
        .withColumn("details", details)
        .withColumn("action", F.coalesce("named", F.lit("index")))
        .withColumn("body", F.when(F.col("action") != "delete", F.try_parse_json("payload")))
    )
    doc = F.when(F.col("action") == "update", _get(F.col("body"), "doc")).otherwise(F.col("body"))
    return parsed.select(
        "file",
        "seq",
        "action",
        F.coalesce(_text(F.col("details"), "_index"), F.lit(default_index).cast("string")).alias("_index"),
        _text(F.col("details"), "_id").alias("_id"),
        doc.alias("doc"),
        (F.col("header").isNull() | ((F.col("action") != "delete") & F.col("body").isNull())).alias("malformed"),
    )


def write_bulk(log: DataFrame, path: str, order: tuple[str, ...] = ("seq",)) -> None:
    """Write an action log as bulk files whose names and lines follow the log's order.

    `doc` may be a VARIANT, or a STRUCT with an optional `present ARRAY<STRING>`
    naming the fields that are set, by dotted paths; without it the non-NULL fields are.
    """
    details = F.to_json(F.struct("_index", "_id"))
    header = F.concat(F.lit('{"'), F.col("action"), F.lit('":'), details, F.lit("}"))
    body = F.coalesce(document_json(log), F.lit("{}"))
    payload = F.when(F.col("action") == "update", F.concat(F.lit('{"doc":'), body, F.lit("}"))).otherwise(body)
    both = F.when(F.col("action") == "delete", header).otherwise(F.concat_ws("\n", header, payload))
    # An action is one row, so its two lines always stay together.
    ordered = log.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select(both.alias("value")).write.text(path)


def document_json(log: DataFrame) -> Column:
    """The log's `doc` as JSON text with exactly its present fields."""
    dtype = log.schema["doc"].dataType
    doc = F.col("doc")
    if isinstance(dtype, T.StringType):
        return doc
    if isinstance(dtype, T.VariantType) or "present" not in log.columns:
        return F.to_json(doc)

    members = F.concat_ws(",", *_members(doc, dtype, "", F.lit(False)))
    return F.when(doc.isNotNull(), F.concat(F.lit("{"), members, F.lit("}")))


def _members(value: Column, dtype: T.StructType, prefix: str, named: Column) -> list[Column]:
    """The members of an object as JSON, NULL for those that `present` does not name; a named object names its members."""
    pairs = []
    for field in dtype.fields:
        member, path = value.getField(field.name), prefix + field.name
        here = named | F.coalesce(F.array_contains("present", path), F.lit(False))
        if isinstance(field.dataType, T.StructType):
            inner = F.concat_ws(",", *_members(member, field.dataType, path + ".", here))
            text, here = F.concat(F.lit("{"), inner, F.lit("}")), here | (inner != "")
            text = F.when(member.isNull() & (named | F.coalesce(F.array_contains("present", path), F.lit(False))), "null").otherwise(text)
        else:
            wrapped = F.to_json(F.struct(member.alias("v")))
            text = F.when(member.isNull(), "null").otherwise(F.substring(wrapped, F.lit(6), F.length(wrapped) - 6))
        pairs.append(F.when(here, F.concat(F.lit(f'"{field.name}":'), text)))
    return pairs


def _get(value: Column, key: str) -> Column:
    return F.try_variant_get(value, f"$.{key}", "variant")


def _text(value: Column, key: str) -> Column:
    """A string member as it is, any other as JSON, so that `{"_id": 1}` gives `1`."""
    return F.try_variant_get(value, f"$.{key}", "string")


def _is_object(value: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.lit(False))
