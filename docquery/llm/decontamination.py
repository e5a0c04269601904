"""Benchmark decontamination by Wu-Manber search for many word patterns.

Every benchmark item gives windows of `window` consecutive words (an item with
fewer words gives one window of all of them). Windows of one length are searched
together. Words are replaced by numbers, a word that no window has by 0. The
search looks at the block of the last words under the current position: the shift
table tells how far the position can move without missing an occurrence. Where it
may not move, the block selects a bucket of windows, and each of them is compared
word by word.

Cases: a NULL or empty text has no words and is never contaminated. An item
without words, or without an id, takes no part. Repeated items count once.
Repeated documents are judged row by row. An empty benchmark contaminates nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import repeat

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from docquery.llm.shared import send
from docquery.llm.tables import unused
from docquery.session import materialize

WINDOW = 13
#: A document is contaminated when at least one word in this many is hit.
WORDS_PER_HIT = 20
#: Bytes of benchmark text that are sent to the executors together. A larger
#: benchmark is searched in several parts, whose results are put together.
PART_BYTES = 16_000_000

#: Words: maximal runs of digits, letters and everything beyond ASCII. A-Z are
#: lower-cased first, which `bytes.lower` does for ASCII alone.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def windows(item: list[bytes], size: int = WINDOW) -> Iterator[tuple[bytes, ...]]:
    if len(item) < size:
        if item:
            yield tuple(item)
        return
    for i in range(len(item) - size + 1):
        yield tuple(item[i : i + size])


class Matcher:
    """Finds windows of one length in sequences of word numbers."""

    def __init__(self, patterns: Iterable[tuple[int, ...]], length: int, base: int):
        self.length = length
        self.base = base
        self.block = min(2, length)
        self.longest = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.buckets: dict[int, list[list[int]]] = {}
        for pattern in patterns:
            for end in range(self.block, length + 1):
                key = self.key(pattern, end)
                self.shift[key] = min(self.shift.get(key, self.longest), length - end)
            self.buckets.setdefault(self.key(pattern, length), []).append(list(pattern))

    def key(self, numbers, end: int) -> int:
        """The block that ends before `end`, as one number."""
        return numbers[end - 1] if self.block == 1 else numbers[end - 2] * self.base + numbers[end - 1]

    def occurrences(self, numbers: list[int]) -> Iterator[tuple[int, tuple[int, ...]]]:
        """Start and numbers of each occurrence of a window."""
        length, two, base, longest = self.length, self.block == 2, self.base, self.longest
        shift, n = self.shift.get, len(numbers)
        i = length - 1
        while i < n:
            block = numbers[i - 1] * base + numbers[i] if two else numbers[i]
            step = shift(block, longest)
            if step:
                i += step
                continue
            start = i - length + 1
            stretch = numbers[start : i + 1]
            for pattern in self.buckets[block]:
                if pattern == stretch:
                    yield start, tuple(pattern)
                    break
            i += 1


class Index:
    """All windows of some items, ready to be sent to executors."""

    def __init__(self, items: Iterable[tuple[str, str]], size: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        self.owners: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            for window in windows(words(text), size):
                key = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in window)
                self.owners.setdefault(key, set()).add(item_id)
        base = len(self.numbers) + 1
        self.matchers = [
            Matcher([k for k in self.owners if len(k) == length], length, base) for length in sorted({len(k) for k in self.owners})
        ]

    def search(self, text: str | None) -> tuple[int, int, list[int], list[str]]:
        """Number of words, number of hit words, hit stretches as [start, end, start, end, ...], ids of the items."""
        found = words(text)
        numbers = list(map(self.numbers.get, found, repeat(0)))
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for matcher in self.matchers:
            for start, pattern in matcher.occurrences(numbers):
                spans.append((start, start + matcher.length))
                items |= self.owners[pattern]
        flat = [x for span in spans for x in span]
        return len(found), covered(flat), flat, sorted(items)


def covered(spans: Iterable[int]) -> int:
    """How many positions lie within at least one of the stretches."""
    flat = list(spans)
    total, reach = 0, 0
    for start, end in sorted(zip(flat[::2], flat[1::2], strict=True)):
        total += max(0, end - max(start, reach))
        reach = max(reach, end)
    return total


def parts(benchmark: DataFrame, part_bytes: int = PART_BYTES, window: int = WINDOW) -> Iterator[Index]:
    """The benchmark as indexes of about `part_bytes` bytes of text each, at least one, made one after the other."""
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text").alias("text")).filter(
        F.col("id").isNotNull() & F.col("text").isNotNull()
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = 1 + total // part_bytes
    placed = items.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(count)))
    for i in range(count):
        yield Index(map(tuple, placed.filter(F.col("part") == i).select("id", "text").collect()), window)


def _search_with(index, spark) -> Column:
    shared = send(spark, index)

    @F.pandas_udf("n_words long, n_hit long, spans array<int>, items array<string>")
    def search(texts: pd.Series) -> pd.DataFrame:
        own = shared()
        return pd.DataFrame([own.search(t) for t in texts], columns=["n_words", "n_hit", "spans", "items"])

    return search


@F.pandas_udf(LongType())
def _covered(spans: pd.Series) -> pd.Series:
    return pd.Series([covered(s) for s in spans], dtype="int64")


def search(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES, name: str = "_found", window: int = WINDOW) -> DataFrame:
    """`docs` with a column `name`: n_words, n_hit, items (ids as text, sorted) and contaminated.

    A benchmark of several parts is searched part by part. What a part finds is
    written before the next part's index is made, so that the driver and the
    executors hold one index at a time; only documents with finds are written.
    """
    indexes = parts(benchmark, part_bytes, window)
    first = next(indexes)
    found = _search_with(first, docs.sparkSession)(F.col("text"))
    following = next(indexes, None)
    if following is None:
        rows = docs.withColumn(name, found)
        n_hit, items = F.col(f"{name}.n_hit"), F.col(f"{name}.items")
    else:
        key, hits = unused(docs, "_row", "_hits")
        rows = materialize(docs.withColumn(key, F.monotonically_increasing_id()).withColumn(name, found), "documents")
        finds = [rows.select(key, F.col(f"{name}.spans").alias("spans"), F.col(f"{name}.items").alias("items")).filter(F.size("spans") > 0)]
        while following is not None:
            part = rows.select(key, _search_with(following, docs.sparkSession)(F.col("text")).alias("part"))
            finds.append(materialize(part.select(key, "part.spans", "part.items").filter(F.size("spans") > 0), "finds"))
            following = next(indexes, None)
        merged = reduce(DataFrame.unionByName, finds).groupBy(key).agg(
            F.struct(_covered(F.flatten(F.collect_list("spans"))).alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).alias(hits)
        )
        rows = rows.join(merged, key, "left").drop(key)
        n_hit = F.coalesce(F.col(f"{hits}.n_hit"), F.lit(0).cast("long"))
        items = F.coalesce(F.col(f"{hits}.items"), F.array().cast("array<string>"))
    n_words = F.col(f"{name}.n_words")
    contaminated = (n_hit > 0) & (n_hit * WORDS_PER_HIT >= n_words)
    merged_column = F.struct(n_words.alias("n_words"), n_hit.alias("n_hit"), items.alias("items"), contaminated.alias("contaminated"))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], merged_column.alias(name))


def report(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document with the counts, the items and the verdict."""
    found = search(docs.select("doc_id", "text"), benchmark, part_bytes)
    return found.select(
        "doc_id",
        "_found.n_words",
        "_found.n_hit",
        F.size("_found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_found.items", ","), 256).alias("items_sha256"),
        "_found.contaminated",
    )


def clean(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    (name,) = unused(docs, "_found")
    return search(docs, benchmark, part_bytes, name).filter(~F.col(f"{name}.contaminated")).drop(name)
