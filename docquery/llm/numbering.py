"""Gapless numbers and neighbours in an order, without sorting a table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.session import materialize

#: Rows are numbered in groups of about so many.
ROWS_PER_GROUP = 10_000


def groups(count: int, per_group: int = ROWS_PER_GROUP) -> int:
    return 1 + count // per_group


def numbered(rows: DataFrame, by: list[str], group: Column, order: list[str], name: str) -> DataFrame:
    """`rows` with `name`, numbers from 0 among the rows of equal `by`, in the order of `group` first.

    Each group is numbered by itself and begins after the groups before it, so a
    value of `by` that a third of all rows share is spread over many tasks. `rows`
    should be a table that was written, since it is read twice.
    """
    keyed = rows.withColumn("_group", group)
    sizes = keyed.groupBy(*by, "_group").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(*by, "_group", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    local = keyed.withColumn("_rank", F.row_number().over(Window.partitionBy(*by, "_group").orderBy(*order)) - 1)
    placed = local.join(begins, [*by, "_group"])
    return placed.withColumn(name, F.col("_before") + F.col("_rank")).drop("_group", "_before", "_rank")


def following(ids: DataFrame, column: str) -> DataFrame:
    """(id, next_id) for the distinct non-NULL ids of `column`; the greatest is followed by the least.

    Ids are dealt into ranges; the last id of a range is followed by the first of
    the next one, which takes one row per range.
    """
    rows = ids.select(F.col(column).alias("id")).filter("id IS NOT NULL").distinct()
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(rows.repartitionByRange(parts, "id").withColumn("part", F.spark_partition_id()), "ranges")
    within = ranged.withColumn("next_id", F.lead("id").over(Window.partitionBy("part").orderBy("id")))
    # One row per range.
    firsts = ranged.groupBy("part").agg(F.min("id").alias("first"))
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("first").over(order), F.min("first").over(whole)).alias("after"))
    return within.join(F.broadcast(after), "part").select("id", F.coalesce("next_id", "after").alias("next_id"))
