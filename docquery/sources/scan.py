"""Reading one index, several indices or an alias as documents."""

from __future__ import annotations

import posixpath
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.model import as_documents, source_type
from docquery.sources.mapping import merge, reshape

#: A split may hold so many times the rows that a core has on average.
UNEVEN = 2


def scan(spark: SparkSession, index: str, id_col: str | list[str] = "_id", name: str | None = None) -> DataFrame:
    """Documents of one index, given as a parquet folder or a table name.

    A table that already has `_source` is taken as it is; of any other table
    every column goes into `_source`, and Catalyst reads only those in use.
    """
    if not index:
        raise ValueError("an index is required")
    df = spark.read.parquet(index) if "/" in index else spark.table(".".join(f"`{part}`" for part in index.split(".")))
    name = name or posixpath.basename(index.rstrip("/")).removesuffix(".parquet")
    if "_source" in df.columns:
        return df if "_index" in df.columns else df.withColumn("_index", F.lit(name))
    return as_documents(df, name, id_col)


def spread(df: DataFrame) -> DataFrame:
    """Use every core for a freshly read table whose rows lie in few tasks, however many splits it comes in.

    For work that is dear per row, such as analyzing text. A file is split by bytes
    but read by row groups, so some splits may hold none; the rows of each are counted from
    the footers. A table that is dealt out evenly is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits < cores:
        return df.repartition(cores)
    # One row per split.
    held = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))
    most, total = held.agg(F.max("n"), F.sum("n")).first()
    return df.repartition(splits) if total and most * cores > UNEVEN * total else df


def scan_many(
    spark: SparkSession, indices: str | Sequence[str] | None = None, id_col: str | list[str] = "_id"
) -> DataFrame:
    """Union of several indices; a string with `*` selects the tables of the catalog it matches, none means all."""
    indices = "*" if indices is None else indices
    if isinstance(indices, str):
        names = [t.name for t in spark.catalog.listTables(pattern=indices)] if "*" in indices else indices.split(",")
    else:
        names = list(indices)
    if not names:
        raise ValueError(f"no index for {indices!r}")
    return union([scan(spark, n, id_col) for n in sorted(names)])


def union(tables: Iterable[DataFrame]) -> DataFrame:
    """Documents of several tables; a field with conflicting types becomes text in all of them."""
    tables = list(tables)
    if not tables:
        raise ValueError("an index is required")
    want = merge([source_type(t) for t in tables])
    ids = {t.schema["_id"].dataType.simpleString() for t in tables}

    def member(df: DataFrame) -> DataFrame:
        key = F.col("_id") if len(ids) == 1 else F.col("_id").cast("string")
        return df.select("_index", key.alias("_id"), reshape(F.col("_source"), source_type(df), want).alias("_source"))

    return reduce(DataFrame.unionByName, map(member, tables))


def alias_scan(members: Iterable[tuple[DataFrame, Column | None]], alias: str | None = None) -> DataFrame:
    """Union of an alias's member indices, each under its own filter; `alias` also names a view of it."""
    df = union([table if predicate is None else table.filter(predicate) for table, predicate in members])
    if alias:
        df.createOrReplaceTempView(alias)
    return df
