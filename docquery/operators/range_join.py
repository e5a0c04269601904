"""Joining rows to intervals without an equality, by ranges of equal share.

The rows' values are cut at their quantiles. An interval is written once for
every range it touches, so both sides meet by equality of the range's number and
the exact bounds are checked after. All ranges but the two at an interval's ends
lie inside it whole, so copies of an interval grow only with what it finds.

A range may be hot: one value may hold a third of all rows, or all intervals may
lie in one range. Such a range is cut into parts, of its rows or of its
intervals, whichever are more, and the other side is copied to every part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.functions.stored import let
from docquery.session import fits_broadcast, materialize

#: Ranges that the values are cut into, and so at most twice as many parts of ranges.
RANGES = 1024
#: Cuts that a value is compared with in each of two steps.
STEP = 32
#: Blocks of a level that make up one of the next, two to the power of `SHIFT`.
SHIFT = 4
BLOCK = 1 << SHIFT


def range_join(
    rows: DataFrame,
    intervals: DataFrame,
    value: str,
    low: str | None,
    high: str | None,
    ranges: int = RANGES,
    small: Callable[[DataFrame], bool] = fits_broadcast,
) -> DataFrame:
    """Every row of `rows` with every one of `intervals` where `low <= value <= high`.

    A bound given as None is open. As in SQL, a NULL value or bound finds
    nothing, and an interval whose `low` is above its `high` is empty. The
    bounds have the type of the value, a number or a time; the columns of both
    sides need different names. The copies of the intervals are sent to all executors
    if `small` says that they fit; otherwise they are shuffled, and the rows too.
    """
    dtype = _checked(rows, intervals, value, low, high)
    taken = {*rows.columns, *intervals.columns}
    at, row_part, interval_part = [_unused(taken, name) for name in ("_range", "_row_part", "_interval_part")]

    cuts = quantiles(rows, value, ranges)
    found = rows.filter(F.col(value).isNotNull()).withColumn(at, range_number(F.col(value), cuts, dtype))
    first = F.lit(0) if low is None else range_number(F.col(low), cuts, dtype)
    last = F.lit(len(cuts)) if high is None else range_number(F.col(high), cuts, dtype)
    spread = materialize(intervals.filter(_holds(low, high)).withColumn(at, F.explode(F.sequence(first, last))), "intervals")

    plan = parts(_counts(found, at), _counts(spread, at), ranges)
    left = _cut(found, plan, at, row_part, interval_part, rows=True)
    right = _cut(spread, plan, at, row_part, interval_part, rows=False)
    inside = F.lit(True)
    if low is not None:
        inside = inside & (F.col(value) >= F.col(low))
    if high is not None:
        inside = inside & (F.col(value) <= F.col(high))
    keys = [at, row_part, interval_part]
    return left.join(F.broadcast(right) if small(right) else right, keys).filter(inside).drop(*keys)


def range_top(
    rows: DataFrame,
    intervals: DataFrame,
    value: str,
    low: str | None,
    high: str | None,
    size: int,
    sort: Sequence[Column],
    ranges: int = RANGES,
    small: Callable[[DataFrame], bool] = fits_broadcast,
) -> DataFrame:
    """Rows of `range_join` among which are the first `size` of every interval, by `sort` over the columns of `rows`.

    The distinct values and bounds are numbered in their order. Blocks of `BLOCK`
    numbers, of `BLOCK` such blocks and so on keep their first `size` rows, and an
    interval is cut into the largest blocks inside it, a few at each level. What it
    finds so grows with the logarithm of the table, not with the rows that lie in it.
    """
    dtype = _checked(rows, intervals, value, low, high)
    taken = {*rows.columns, *intervals.columns}
    at, point, place, start, level, block, rank = [
        _unused(taken, name) for name in ("_range", "_point", "_place", "_start", "_level", "_block", "_best")
    ]

    def best(df: DataFrame, by: str) -> DataFrame:
        ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(F.col(f"`{by}`")).orderBy(*sort)))
        return ranked.filter(F.col(rank) <= size).drop(rank)

    # A value is in an interval with all of its rows, so the first of them will do.
    kept = materialize(best(rows.filter(F.col(value).isNotNull()), value), "best")
    asked = intervals.filter(_holds(low, high))
    points = kept.select(F.col(value).alias(point))
    for bound in (low, high):
        points = points if bound is None else points.unionByName(asked.select(F.col(bound).alias(point)))
    points = materialize(points.distinct(), "points")
    cuts = quantiles(points, point, ranges)
    dealt = points.withColumn(at, range_number(F.col(point), cuts, dtype))
    counts, starts, total = _counts(dealt, at), [], 0
    for k in sorted(counts):
        starts.append((k, total))
        total += counts[k]
    # One entry per range.
    table = F.broadcast(rows.sparkSession.createDataFrame(starts, f"`{at}` int, `{start}` long"))
    number = F.col(start) + F.row_number().over(Window.partitionBy(at).orderBy(point)) - 1
    placed = materialize(dealt.join(table, at).select(point, number.alias(place)), "places")

    top = kept.join(placed, F.col(value) == F.col(point)).drop(point).withColumnRenamed(place, block)
    levels = [materialize(top, "level")]
    while total > BLOCK << (SHIFT * (len(levels) - 1)):
        above = levels[-1].withColumn(block, F.shiftright(block, SHIFT))
        levels.append(materialize(best(above, block), "level"))

    first, end = F.lit(0).cast("long"), F.lit(total).cast("long")
    for bound, name in ((low, at), (high, start)):
        if bound is not None:
            asked = asked.join(placed.select(F.col(point), F.col(place).alias(name)), F.col(bound) == F.col(point)).drop(point)
    first = first if low is None else F.col(at)
    end = end if high is None else F.col(start) + 1
    listed = F.explode(_blocks(first, end, len(levels), level, block)).alias(point)
    spread = materialize(asked.select(*intervals.columns, listed).select(*intervals.columns, f"`{point}`.*"), "intervals")
    numbered = [df.withColumn(level, F.lit(n)) for n, df in enumerate(levels)]
    keys = [level, block]
    return reduce(DataFrame.unionByName, numbered).join(F.broadcast(spread) if small(spread) else spread, keys).drop(*keys)


def _blocks(first: Column, end: Column, levels: int, level: str, block: str) -> Column:
    """`ARRAY<STRUCT<level, block>>`: the largest blocks that make up the numbers from `first` to before `end`, at most twice `BLOCK` of a level."""

    def whole(n: int) -> tuple[Column, Column]:
        """The blocks of a level that lie inside, from one to before the other."""
        return F.shiftright(first + ((1 << SHIFT * n) - 1), SHIFT * n), F.shiftright(end, SHIFT * n)

    def between(a: Column, b: Column) -> Column:
        return F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))

    out = []
    for n in range(levels):
        a, b = whole(n)
        numbers = between(a, b)
        if n + 1 < levels:
            up_a, up_b = whole(n + 1)
            sides = F.concat(between(a, up_a * BLOCK), between(up_b * BLOCK, b))
            numbers = F.when(up_a < up_b, sides).otherwise(numbers)
        out.append(_numbered(numbers, n, level, block))
    return F.concat(*out)


def _numbered(blocks: Column, n: int, level: str, block: str) -> Column:
    return F.transform(blocks, lambda k: F.struct(F.lit(n).alias(level), k.alias(block)))


def _checked(rows: DataFrame, intervals: DataFrame, value: str, low: str | None, high: str | None) -> T.DataType:
    """The type of the value, when rows and intervals can be joined."""
    if low is None and high is None:
        raise ValueError("an interval needs a bound")
    dtype = rows.schema[value].dataType
    if not isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{value} has no quantiles, it is {dtype.simpleString()}")
    if any(intervals.schema[bound].dataType != dtype for bound in (low, high) if bound is not None):
        raise ValueError(f"the bounds of {value} are not all of its type, {dtype.simpleString()}")
    if len({*rows.columns, *intervals.columns}) < len(rows.columns) + len(intervals.columns):
        raise ValueError("rows and intervals have a column of one name")
    return dtype


def _holds(low: str | None, high: str | None) -> Column:
    """An interval has all its bounds, in order."""
    whole = F.lit(True)
    for bound in (low, high):
        whole = whole & (F.lit(True) if bound is None else F.col(bound).isNotNull())
    if low is not None and high is not None:
        whole = whole & (F.col(low) <= F.col(high))
    return whole


def quantiles(rows: DataFrame, value: str, ranges: int) -> list:
    """The distinct values, in order, that cut the rows into about `ranges` ranges of equal share."""
    share = [k / ranges for k in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx(value, F.lit(share), 10 * ranges)).first()[0] if share else None
    out: list = []
    for cut in cuts or []:
        if not out or cut != out[-1]:
            out.append(cut)
    return out


def range_number(value: Column, cuts: list, dtype: T.DataType) -> Column:
    """How many cuts lie at or below a value, looked up in two steps of few comparisons."""
    if not cuts:
        return F.lit(0)
    blocks = [cuts[k : k + STEP] for k in range(0, len(cuts), STEP)]

    def listed(values: list) -> Column:
        return F.array(*[F.lit(v).cast(dtype) for v in values])

    def passed(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda bound: bound <= value))

    block = F.greatest(passed(listed([b[0] for b in blocks])) - 1, F.lit(0))
    return let(block, lambda b: b * STEP + passed(F.get(F.array(*map(listed, blocks)), b)))


def parts(rows: dict[int, int], intervals: dict[int, int], ranges: int) -> list[tuple[int, int, int]]:
    """(range, parts of its rows, parts of its intervals) for the ranges where both sides have any.

    The work of a range is the pairs in it; one with more than an even share is cut into as many parts.
    """
    work = {k: n * intervals[k] for k, n in rows.items() if k in intervals}
    even = max(1, -(-sum(work.values()) // max(ranges, 1)))
    out = []
    for k in sorted(work):
        many = -(-work[k] // even)
        out.append((k, min(many, rows[k]), 1) if rows[k] >= intervals[k] else (k, 1, min(many, intervals[k])))
    return out


def _counts(df: DataFrame, at: str) -> dict[int, int]:
    """Rows of each range; no more entries than ranges."""
    return {r[0]: r[1] for r in df.groupBy(at).agg(F.count(F.lit(1))).collect()}


def _cut(df: DataFrame, plan: list[tuple[int, int, int]], at: str, row_part: str, interval_part: str, rows: bool) -> DataFrame:
    """Each row in one part of its own side, and copied to all parts of the other side."""
    own, other = (row_part, interval_part) if rows else (interval_part, row_part)
    # One entry per range.
    table = df.sparkSession.createDataFrame(plan, f"`{at}` int, `{row_part}` int, `{interval_part}` int")
    placed = df.join(F.broadcast(table), at)
    lot = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c != at]), F.col(own))
    return placed.withColumn(own, lot.cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))


def _unused(taken: set[str], name: str) -> str:
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    taken.add(name)
    return name
