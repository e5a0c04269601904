"""What tables hold: document counts, files, bytes per field, field types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.model import leaves, quoted, source_type
from docquery.functions.stored import NESTED
from docquery.session import materialize
from docquery.sources.mapping import mapping_of

# Bytes of a fixed-width value.
WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}

# Names of the types that values of a VARIANT have.
VARIANT_TYPES = {
    "STRING": "text", "BIGINT": "long", "DECIMAL": "double", "DOUBLE": "double", "FLOAT": "double", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "date", "TIMESTAMP_NTZ": "date", "BINARY": "binary",
}

STATS = ("docs", "deleted", "store")


def stats(df: DataFrame, metrics: Sequence[str] = STATS, deleted: Column | None = None) -> DataFrame:
    """Per index the chosen metrics: `docs` live rows, `deleted` superseded rows, `store` bytes of its values."""
    unknown = set(metrics) - set(STATS)
    if unknown:
        raise ValueError(f"unknown metrics {sorted(unknown)}; known: {STATS}")
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    parts = {
        "docs": F.count_if(~gone).alias("docs"),
        "deleted": F.count_if(gone).alias("deleted"),
        "store": F.coalesce(F.sum(_row_bytes(source_type(df))), F.lit(0)).alias("store"),
    }
    return df.groupBy("_index").agg(*[parts[m] for m in metrics])


def segments(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file, known by its path: rows, bytes and time of its last change. No column of the data is read."""
    return (
        spark.read.parquet(path)
        .groupBy(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_size").alias("bytes"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def disk_usage(df: DataFrame) -> DataFrame:
    """Bytes and non-NULL values of every field, in one pass over the table."""
    fields = list(leaves(source_type(df)))
    aggregates = []
    for n, (path, dtype) in enumerate(fields):
        col = F.col(quoted(("_source", *path)))
        aggregates += [F.count(col).alias(f"n{n}"), F.coalesce(F.sum(_bytes(col, dtype)), F.lit(0)).alias(f"b{n}")]
    entries = [
        F.struct(F.lit(".".join(path)).alias("field"), F.col(f"n{n}").alias("values"), F.col(f"b{n}").alias("bytes"))
        for n, (path, _) in enumerate(fields)
    ]
    return df.groupBy("_index").agg(*aggregates).select("_index", F.inline(F.array(*entries)))


def search_shards(spark: SparkSession, path: str, predicate: Column | None = None) -> DataFrame:
    """The shards and files a search would touch, with the rows it would find in each."""
    df = spark.read.parquet(path)
    shard = F.col("_shard") if "_shard" in df.columns else F.lit(0).alias("_shard")
    rows = df if predicate is None else df.filter(predicate)
    return rows.groupBy(shard, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def field_caps(
    tables: Mapping[str, DataFrame], fields: Sequence[str] | None = None, index_filter: Column | None = None
) -> DataFrame:
    """Per index and field: its type, whether the field's types conflict, and whether it holds data.

    Types come from the schemas; the data part is one aggregation per table. Those of
    a table of VARIANT bodies come from its values, see `variant_fields`; a
    field may have several there.
    """
    parts = [_caps(name, df, fields, index_filter) for name, df in tables.items()]
    listed = parts[0]
    for part in parts[1:]:
        listed = listed.unionByName(part)
    # A few rows per table: its fields.
    types = listed.groupBy("field").agg(F.countDistinct("type").alias("_types"))
    return listed.join(types, "field").select(
        "field", "type", "_index", (F.col("_types") > 1).alias("conflict"), "has_data"
    )


def _caps(name: str, df: DataFrame, fields: Sequence[str] | None, index_filter: Column | None) -> DataFrame:
    rows = df if index_filter is None else df.filter(index_filter)
    if isinstance(df.schema["_source"].dataType, T.VariantType):
        found = variant_fields(rows)
        found = found if fields is None else found.filter(F.col("field").isin(list(fields)))
        return found.select("field", "type", F.lit(name).alias("_index"), F.lit(True).alias("has_data"))
    listed = [(p, t) for p, t in leaves(source_type(df)) if fields is None or ".".join(p) in fields]
    if not listed:
        raise ValueError(f"{name} has none of the fields {list(fields or ())}")
    filled = rows.agg(*[(F.count(F.col(quoted(("_source", *p)))) > 0).alias(f"d{n}") for n, (p, _) in enumerate(listed)])
    entries = [
        F.struct(
            F.lit(".".join(p)).alias("field"), F.lit(_type_name(df, p)).alias("type"), F.lit(name).alias("_index"), F.col(f"d{n}").alias("has_data")
        )
        for n, (p, _) in enumerate(listed)
    ]
    return filled.select(F.inline(F.array(*entries)))


def variant_fields(df: DataFrame, column: str = "_source") -> DataFrame:
    """`(field, type, values)` of VARIANT bodies: every path below them, each type that it has, and how many values of it.

    Lists count by their elements. A path of whole and broken numbers is a
    double. A path that holds objects is `object` where it holds other values
    too, else only its members are listed. NULLs and empty objects and lists
    make no field. There is one pass per level of nesting, which reads the
    bodies and shuffles a row per task, path and type.
    """
    level = df.select(F.lit(None).cast("string").alias("path"), F.col(column).alias("value"))
    counted = None
    while True:
        opened = level.filter(F.col("value").isNotNull()).select(
            "path",
            "value",
            F.try_variant_get("value", "$", "map<string,variant>").alias("members"),
            F.try_variant_get("value", "$", "array<variant>").alias("elements"),
        )
        plain = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z_]+", 0)
        kind = F.when(F.col("members").isNotNull(), "object").when(F.col("elements").isNotNull(), "list").otherwise(plain)
        found = materialize(opened.groupBy("path", kind.alias("kind")).agg(F.count(F.lit(1)).alias("values")), "paths")
        counted = found if counted is None else counted.unionByName(found)
        if not found.filter(F.col("kind").isin("object", "list")).limit(1).count():
            break
        # The path of a member; elements have that of their list.
        below = F.transform(F.map_entries("members"), lambda m: F.struct(F.concat_ws(".", "path", m["key"]).alias("path"), m["value"].alias("value")))
        inside = F.transform("elements", lambda e: F.struct(F.col("path").alias("path"), e.alias("value")))
        # The outer form, since for the plain one Spark adds a filter that opens the value again.
        level = opened.select(F.inline_outer(F.coalesce(below, inside)))
    known = F.create_map(*[F.lit(x) for pair in VARIANT_TYPES.items() for x in pair])
    named = counted.filter(F.col("path").isNotNull() & ~F.col("kind").isin("list", "VOID"))
    types = named.select("path", F.coalesce(F.try_element_at(known, "kind"), F.lower("kind")).alias("type"), "values")
    totals = types.groupBy("path", "type").agg(F.sum("values").alias("values"))
    # A few rows per path.
    of_path = totals.groupBy("path").agg(F.collect_set("type").alias("types"), F.map_from_entries(F.collect_list(F.struct("type", "values"))).alias("n"))
    other = F.array_size(F.array_remove("types", "object")) > 0
    broken = F.array_contains("types", "double")
    kept = F.filter("types", lambda t: ((t != "object") | other) & ((t != "long") | ~broken))
    each = of_path.select("path", "n", broken.alias("broken"), F.explode(kept).alias("type"))
    whole = F.when(F.col("broken") & (F.col("type") == "double"), F.coalesce(F.try_element_at("n", F.lit("long")), F.lit(0))).otherwise(0)
    return each.select(F.col("path").alias("field"), "type", (F.element_at("n", F.col("type")) + whole).alias("values"))


def _type_name(df: DataFrame, path: tuple) -> str:
    mapping = mapping_of(source_type(df))
    for name in path:
        mapping = mapping["properties"][name]
    return mapping["type"]


def _row_bytes(struct: T.StructType) -> Column:
    total = F.lit(0)
    for path, dtype in leaves(struct):
        total = total + F.coalesce(_bytes(F.col(quoted(("_source", *path))), dtype), F.lit(0))
    return total


def _bytes(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.octet_length(col).cast("long")
    if isinstance(dtype, (*NESTED, T.VariantType)):
        return F.octet_length(F.to_json(col)).cast("long")
    return F.when(col.isNotNull(), F.lit(WIDTHS.get(dtype.simpleString(), 8)).cast("long"))
