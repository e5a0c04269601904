"""`ip` fields: address text <-> STRUCT<version TINYINT, bytes BINARY>."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquery.functions.stored import let

V4 = r"\A(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}\z"
V6_GROUPS = r"\A[0-9a-f]{0,4}(:[0-9a-f]{0,4}){1,8}\z"
V4_TAIL = r"\A(.*:)(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})\z"


def load_ip(col: Column) -> Column:
    """Address as version and network-order bytes; NULL when the text is no address."""
    v4 = F.when(col.rlike(V4), _address(4, _v4_hex(col)))
    v6 = F.when(F.contains(col, F.lit(":")), let(F.lower(col), lambda text: let(_dotted_tail_as_groups(text), _load_v6)))
    return F.coalesce(v4, v6)


def dump_ip(col: Column) -> Column:
    """Dotted IPv4, or IPv6 in lower case with its first longest run of zero groups written as `::`.

    An IPv4 address mapped into IPv6 keeps its dotted tail.
    """
    return let(F.hex(col.getField("bytes")), _dump_digits)


def _dump_digits(digits: Column) -> Column:
    groups = [F.substring(digits, 4 * i + 1, 4) for i in range(8)]
    v6 = let(F.lower(F.concat_ws(":", *[F.regexp_replace(g, "^0{1,3}", "") for g in groups])), _compress)
    mapped = F.concat(F.lit("::ffff:"), _dotted(F.substring(digits, 25, 8)))
    size = F.length(digits)
    return (
        F.when(size == 8, _dotted(digits))
        .when((size == 32) & F.startswith(digits, F.lit("0" * 20 + "FFFF")), mapped)
        .when(size == 32, v6)
    )


def _dotted(digits: Column) -> Column:
    return F.concat_ws(".", *[F.conv(F.substring(digits, 2 * i + 1, 2), 16, 10) for i in range(4)])


def _address(version: int, hex_digits: Column) -> Column:
    return F.struct(F.lit(version).cast("tinyint").alias("version"), F.unhex(hex_digits).alias("bytes"))


def _v4_hex(col: Column) -> Column:
    parts = F.split(col, r"\.")
    return F.concat(*[F.lpad(F.conv(F.get(parts, F.lit(i)), 10, 16), 2, "0") for i in range(4)])


def _dotted_tail_as_groups(text: Column) -> Column:
    """A dotted tail stands for the last two groups."""
    tail = F.regexp_extract(text, V4_TAIL, 2)
    groups = F.concat(F.regexp_extract(text, V4_TAIL, 1), F.regexp_replace(F.lower(_v4_hex(tail)), "^(.{4})", "$1:"))
    return F.when(tail.rlike(V4), groups).otherwise(text)


def _load_v6(text: Column) -> Column:
    halves = F.split(text, "::")
    shape = text.rlike(V6_GROUPS) & (F.size(halves) <= 2)
    bytes_of = let(
        F.struct(
            _groups(F.get(halves, F.lit(0))).alias("head"),
            _groups(F.get(halves, F.lit(1))).alias("rest"),
            (F.size(halves) == 2).alias("gap"),
        ),
        _v6_address,
    )
    return F.when(shape, bytes_of)


def _v6_address(parts: Column) -> Column:
    head, rest, gap = (parts.getField(n) for n in ("head", "rest", "gap"))
    count = F.size(head) + F.size(rest)
    zeros = F.array_repeat(F.lit("0000"), F.greatest(F.lit(8) - count, F.lit(0)))
    digits = F.array_join(F.concat(_padded(head), zeros, _padded(rest)), "")
    filled = F.forall(F.concat(head, rest), lambda g: F.length(g) > 0)
    complete = F.when(gap, count <= 7).otherwise(count == 8)
    return F.when(filled & complete, _address(6, digits))


def _groups(half: Column) -> Column:
    return F.when(F.length(half) > 0, F.split(half, ":")).otherwise(F.array().cast("array<string>"))


def _padded(groups: Column) -> Column:
    return F.transform(groups, lambda g: F.lpad(g, 4, "0"))


def _compress(text: Column) -> Column:
    """Replace the first longest run of two or more zero groups."""

    def shorten(run: int) -> tuple[Column, Column]:
        zeros = f"0(:0){{{run - 1}}}(:|$)"
        at_start, inside = f"^{zeros}", f"^(.+?:){zeros}"
        value = F.when(text.rlike(at_start), F.regexp_replace(text, at_start, "::")).otherwise(
            F.regexp_replace(text, inside, "$1:")
        )
        return text.rlike(at_start) | text.rlike(inside), value

    options = [shorten(run) for run in range(8, 1, -1)]
    first = F.when(*options[0])
    return reduce(lambda chain, option: chain.when(*option), options[1:], first).otherwise(text)
