"""Reading a large sorted result page by page, and numbering all pages of an export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquery.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def page(df: DataFrame, keys: Sequence[str | tuple[str, bool]], after: Sequence | None = None, size: int = 10) -> DataFrame:
    """The `size` rows following the row with the key values `after`; the first page without it.

    A key is a column name, or (name, descending); NULLs come first in ascending
    and last in descending order. The keys must end in a unique column. Later pages cost no more than the
    first: a keyset filter and a top-k, no sort of the table.
    """
    pairs = [(key, False) if isinstance(key, str) else key for key in keys]
    if after is not None:
        df = df.filter(_beyond(pairs, after))
    return df.orderBy(*[F.desc_nulls_last(k) if down else F.asc_nulls_first(k) for k, down in pairs]).limit(size)


def number_pages(df: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Every row with its page number `_page`, from 1, in the order of `keys`."""
    placed = with_position(df, keys)
    return placed.withColumn("_page", F.floor((F.col("_position") - 1) / size) + 1).drop("_position")


def with_position(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add `_position`, the 1-based rank of each row in the order of `keys` (ending in a unique column).

    Rows are range-partitioned and sorted, so no task gets more than its share
    however the keys are distributed. The sorted rows are written once to the
    shared folder: partition sizes and positions then refer to the same
    partitions even when an executor is lost in between.
    """
    # Each range gets an equal share of the sampled rows, so all cores are used on small tables too.
    ranges = max(
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism
    )
    ordered = materialize(
        df.repartitionByRange(ranges, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _ROW_BITS))
        .withColumn("_row", F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("_at"),
        "positions",
    )
    # One row per partition.
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    placed = ordered.join(F.broadcast(offsets), "_part")
    return placed.withColumn("_position", F.col("_offset") + F.col("_row") + 1).drop("_part", "_row", "_offset")


def _beyond(keys: Sequence[tuple[str, bool]], after: Sequence) -> Column:
    condition = F.lit(False)
    equal = F.lit(True)
    for (key, down), value in zip(keys, after, strict=True):
        column = F.col(key)
        if value is None:
            further = F.lit(False) if down else column.isNotNull()
        elif down:
            further = column.isNull() | (column < F.lit(value))
        else:
            further = column > F.lit(value)
        condition = condition | (equal & F.coalesce(further, F.lit(False)))
        equal = equal & column.eqNullSafe(F.lit(value))
    return condition
