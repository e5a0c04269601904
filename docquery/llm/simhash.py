"""SimHash fingerprints and near-duplicates among them by multi-index hashing.

A fingerprint has 64 bits. It is cut into segments; two fingerprints that differ
in at most `distance` bits differ in few bits of at least one segment, so each
fingerprint asks, for every segment, for all values in a small Hamming ball
around its own. Matches of a segment's table are verified on all 64 bits.

Documents with one fingerprint are one node from the start, so copies never meet
in pairs. Groups of close fingerprints are gathered before the search: those
that have a common fingerprint within half the distance around them are linked
to the least of them, which costs one row per ball member instead of all pairs.
The search then only reports links between groups.

Cases: a NULL, empty or blank text has no words and fingerprint 0, which links
like any other. Repeated rows are judged row by row. The component of documents
none of which has an id is NULL. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquery.llm.components import components
from docquery.llm.tables import unused
from docquery.session import bounded_broadcast, join_statistics, materialize

SHINGLE = 4
DISTANCE = 4
SEGMENTS = 3
SEED = 42
#: Fingerprints with more than this many others in a segment are gathered before the search.
CROWD = 16
BITS = 64


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, as a signed 64-bit number."""
    # bytes.lower changes A-Z only; bytes.split cuts at 0x20 and 0x09-0x0D.
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        hashes = digest(joined, SEED)
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        spans = zip((ends - lengths)[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        hashes = b"".join([digest(joined[start:end], SEED) for start, end in spans])
    bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8)).reshape(-1, BITS)
    # Up to 255 rows add up in bytes, which is several times faster than in wide numbers.
    whole = len(bits) // 255 * 255
    ones = bits[whole:].sum(axis=0, dtype=np.uint8).astype(np.int64)
    if whole:
        ones += bits[:whole].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(bits)).view(">i8")[0])


def fingerprint_column(shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return of("text")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row."""
    return docs.select("doc_id", fingerprint_column(shingle).alias("fp"))


def segments(count: int = SEGMENTS, distance: int = DISTANCE) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) of each segment.

    With distance = count * r + a, a pair within the distance differs in at most
    r bits in one of the first a + 1 segments, or in at most r - 1 bits in one of
    the others.
    """
    r, a = divmod(distance, count)
    edges = [BITS * i // count for i in range(count + 1)]
    radii = [r if i <= a else r - 1 for i in range(count)]
    return [(lo, hi - lo, radius) for lo, hi, radius in zip(edges, edges[1:], radii, strict=False) if radius >= 0]


def segments_for(prints: int, distance: int = DISTANCE) -> int:
    """How many segments ask least of `prints` fingerprints: values asked for, and fingerprints met at each."""

    def cost(count: int) -> float:
        return sum(len(ball(bits, radius)) * (1 + prints / 2**bits) for _, bits, radius in segments(count, distance))

    return min((SEGMENTS, 2), key=cost)


def ball(bits: int, radius: int) -> list[int]:
    """All masks of up to `radius` of `bits` bits, 0 first."""
    return [sum(1 << b for b in chosen) for k in range(radius + 1) for chosen in combinations(range(bits), k)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def crowded(prints: DataFrame, pieces: int, least: int = CROWD) -> DataFrame:
    """The fingerprints that share one of `pieces` segments with at least `least` others."""
    edges = [BITS * i // pieces for i in range(pieces + 1)]
    values = F.array(
        *[
            F.struct(F.lit(i).alias("segment"), F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long")).alias("value"))
            for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))
        ]
    )
    rows = prints.select("fp", F.explode(values).alias("at")).select("fp", "at.*")
    many = rows.groupBy("segment", "value").count().filter(F.col("count") > least).drop("count")
    return rows.join(many, ["segment", "value"]).select("fp").distinct()


def gathered(prints: DataFrame, distance: int = DISTANCE, least: int = CROWD) -> DataFrame:
    """(a, b) links that join crowded fingerprints with a common fingerprint within a quarter of the distance.

    All who have a value in their ball are within half the distance of each other,
    so each is linked to the least of them. Two of them differ in fewer bits than
    there are pieces, so they share one: a fingerprint without a crowd in any
    piece is in no large group, and the search itself finds its few links.
    """
    radius = distance // 4
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in ball(BITS, radius)])
    dense = crowded(prints, 2 * radius + 1, least)
    balls = dense.select("fp", F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("fp")))).alias("value"))
    ends = balls.groupBy("value").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).filter("top > b")
    return balls.join(ends, "value").filter("fp > b").select(F.col("fp").alias("a"), "b").distinct()


def links(prints: DataFrame, distance: int = DISTANCE, count: int = SEGMENTS) -> DataFrame:
    """(a, b, bits, a_group, b_group) for the pairs of `prints` (fp, group) of different groups within the distance."""
    rows = prints.select(F.col("fp"), F.col("group"))
    asked = held = None
    for number, (first, bits, radius) in enumerate(segments(count, distance)):
        own = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
        masks = F.array(*[F.lit(m).cast("long") for m in ball(bits, radius)])
        part = rows.select("fp", "group", F.lit(number).alias("segment"), own.alias("value"))
        # Only values above the own one are asked for: the other side of a pair finds the rest.
        probe = part.withColumn("mask", F.explode(masks)).withColumn("asked", F.col("value").bitwiseXOR(F.col("mask")))
        probe = probe.filter("asked >= value").select("fp", "group", "segment", F.col("asked").alias("value"), "mask")
        asked = probe if asked is None else asked.unionByName(probe)
        held = part if held is None else held.unionByName(part)
    x, y = asked.alias("x"), held.alias("y")
    bits = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp")))
    return x.join(
        y,
        (F.col("x.segment") == F.col("y.segment"))
        & (F.col("x.value") == F.col("y.value"))
        & ((F.col("x.mask") != 0) | (F.col("x.fp") < F.col("y.fp")))
        & (F.col("x.group") != F.col("y.group"))
        & (bits <= distance),
    ).select(
        F.col("x.fp").alias("a"), F.col("y.fp").alias("b"), bits.alias("bits"), F.col("x.group").alias("a_group"), F.col("y.group").alias("b_group")
    )


def rooted(rows: DataFrame, distance: int = DISTANCE, count: int | None = None) -> DataFrame:
    """(fp, least, n, root) for the fingerprints of `rows` (doc_id, fp): the least doc_id and the number of rows of each, and the
    fingerprint its component is named by. Without a `count` of segments it is chosen by the number of fingerprints."""
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "prints")
    count = count or segments_for(prints.count(), distance)
    close = materialize(gathered(prints, distance), "close")
    first = components(close)
    placed = prints.join(bounded_broadcast(first), F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("group"))
    found = links(materialize(placed, "placed"), distance, count)
    # The gathered groups are stars by now; what was found links their centres.
    stars = first.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(stars.unionByName(found.select(F.col("a_group").alias("a"), F.col("b_group").alias("b"))))
    return prints.join(bounded_broadcast(roots), F.col("fp") == F.col("node"), "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, count: int | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the least doc_id that links lead to."""
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    roots = materialize(rooted(rows, distance, count), "rooted")
    # `prints` tells how many fingerprints a root has, as one key may have very many.
    ids = materialize(roots.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("prints")), "ids")
    named = materialize(join_statistics(roots, ids, "root", "prints").select("fp", "component_id", "n"), "named")
    return join_statistics(rows, named, "fp", "n").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _row_key(docs: DataFrame) -> Column:
    """The same for rows equal in all columns, and for no others: two salted hashes of the values and of where they are NULL."""
    values = [c for name in docs.columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return F.struct(F.xxhash64(F.lit(1), *values).alias("a"), F.xxhash64(F.lit(2), *values).alias("b"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents without the near-copies: one row of each component stays, the one with the least id.

    Rows without an id come last; among rows of one id, and among those without,
    the least hash of the text decides. A repeated row stays once.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", fingerprint_column(shingle).alias("fp"), F.xxhash64(text).alias("hash"), _row_key(docs).alias("key"))
    rows = materialize(rows, "fingerprints")
    # One row per fingerprint comes to the join, however many documents have it.
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "hash", "key")
    firsts = materialize(rows.groupBy("fp").agg(F.min(order).alias("first")), "firsts")
    kept = firsts.join(rooted(rows.select("doc_id", "fp"), distance), "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.key.a").alias("_a"), F.col("first.key.b").alias("_b")).distinct()
    key, a, b = unused(docs, "_key", "_a", "_b")
    named = docs.withColumn(key, _row_key(docs)).withColumn(a, F.col(f"{key}.a")).withColumn(b, F.col(f"{key}.b"))
    kept = kept.select(F.col("_a").alias(a), F.col("_b").alias(b))
    return named.join(kept, [a, b], "left_semi").dropDuplicates([a, b]).select(*[F.col(f"`{c}`") for c in docs.columns])
