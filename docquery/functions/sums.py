"""Running sums inside a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquery.functions.stored import let


#: Members that are summed up by appending.
BLOCK = 16


def running_sums(values: Column) -> Column:
    """The sums of an array's first one, two, ... members, as an array of the same size.

    Short blocks are summed up by an aggregation that appends, which copies a block for
    every member, and each block is then raised by the sum of those before it.
    """

    def append(sums: Column, value: Column) -> Column:
        return F.array_append(sums, F.when(F.size(sums) == 0, value).otherwise(F.element_at(sums, -1) + value))

    def in_blocks(all_: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(all_), F.lit(BLOCK))
        none = F.array().cast("array<bigint>")
        blocks = F.transform(starts, lambda k: F.aggregate(F.slice(all_, k, F.lit(BLOCK)), none, append))
        return let(blocks, lambda own: let(_doubling(F.transform(own, lambda b: F.element_at(b, -1))), lambda ends: raised(own, ends)))

    def raised(blocks: Column, ends: Column) -> Column:
        def one(block: Column, i: Column) -> Column:
            return F.when(i == 0, block).otherwise(let(F.get(ends, i - 1), lambda before: F.transform(block, lambda x: x + before)))

        return F.flatten(F.transform(blocks, one))

    return let(F.transform(values, lambda v: v.cast("long")), lambda all_: F.when(F.size(all_) > 0, in_blocks(all_)).otherwise(all_))


def _doubling(sums: Column) -> Column:
    """Running sums of longs, by steps that each add to every sum the one that ends where it begins, so the stretches summed up double."""

    def step(sums: Column, power: Column) -> Column:
        reach = F.call_function("shiftleft", F.lit(1), power)
        earlier = F.concat(F.array_repeat(F.lit(0).cast("long"), reach), F.slice(sums, F.lit(1), F.size(sums) - reach))
        return F.zip_with(sums, earlier, lambda x, y: x + y)

    def add_up(all_: Column) -> Column:
        powers = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda p: F.call_function("shiftleft", F.lit(1), p) < F.size(all_))
        return F.aggregate(powers, all_, step)

    return let(sums, add_up)
