"""Drawing documents that look like a target: hashed n-gram importance weights and a Gumbel top-k.

A text's separators are collapsed to single spaces; one overlapped regular
expression scan, whose lookarounds hold at word borders, then emits the spans of
the one, two and three words that start at each word, and the CRC of each span
names its bucket. Documents keep their buckets in a written table, so texts are
scanned once however often the buckets are used. The target's and the corpus's
bucket totals, a table of fixed size, give each bucket a gain; a document's
weight is the sum of its features' gains. Weight plus Gumbel noise taken from
the id gives a sample without replacement when the highest scores are drawn.

Cases: a NULL, empty or wordless text has no features and weight 0. Repeated
rows, and rows of one id, are scored and drawn row by row; among rows equal in
score and id any may come first, which leaves the result the same. A NULL id
takes the noise of the empty id and comes last among ties. An empty table gives
an empty result; an empty target leaves only the corpus's counts. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice, repeat
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquery.llm.shared import send
from docquery.operators.paging import with_position
from docquery.session import materialize

BUCKETS = 10_000
WORDS = 3
SEED = 42
#: Share of the eligible documents that is drawn, in hundredths, and the words a document needs to be eligible.
PERCENT = 5
LEAST_WORDS = 20
#: Matches taken from a scan at once, which bounds the memory a very long text needs beside its buckets.
CHUNK = 2_000

_LETTERS = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
#: Lower-cases A-Z and turns separators into spaces. Every byte of a character above 0x7F is at least 0x80, so separators are single bytes.
_PLAIN = bytes(c if c in _LETTERS else 0x20 for c in bytes(range(0x100)).lower())


@lru_cache
def _scanner(words: int) -> regex.Pattern:
    """A match stands before a word; its groups are the spans that the run grows by with each further word.

    The border on the left is a plain space, which the scan leaps to, instead of
    a lookbehind, which it would try at every byte (twice the time).
    """
    return regex.compile(rb" ([^ ]+)" + rb"( [^ ]*)" * (words - 1) + rb"(?= )")


def buckets(text: str | None, words: int = WORDS, count: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every run of up to `words` consecutive ones."""
    plain = b" ".join(text.encode("utf-8", "surrogatepass").translate(_PLAIN).split()) if text else b""
    if not plain:
        return 0, np.empty(0, dtype=np.uint16)
    # Behind the last word stand empty ones, so that every word opens a full run; those runs are taken out again below.
    found = _scanner(words).finditer(b" " + plain + b" " * words, overlapped=True)
    parts = []
    while part := _sums(found):
        parts.append(np.array(part, dtype=np.uint32) % count)
    sums = np.concatenate(parts, axis=1).astype(np.uint16)
    total = sums.shape[1]
    # The last run of k words starts k - 1 words before the last word.
    return total, np.concatenate([sums[k, : max(total - k, 0)] for k in range(words)])


def _sums(found: Iterator[regex.Match]) -> list[list[int]]:
    """The CRCs of the runs of the next matches, by length; each is carried on from the run that is a word shorter."""
    spans = [match.groups() for match in islice(found, CHUNK)]
    out: list[list[int]] = []
    for column in zip(*spans):
        out.append(list(map(crc32, column, out[-1] if out else repeat(0))))
    return out


def features(docs: DataFrame, keys: list[str], words: int = WORDS, count: int = BUCKETS) -> DataFrame:
    """`keys`, n_words, n_features and the buckets as little-endian 16-bit numbers, for every row."""
    if not 0 < count <= 1 << 16:
        raise ValueError("a bucket is a 16-bit number")

    @F.pandas_udf("n_words long, n_features long, buckets binary")
    def scan(texts: pd.Series) -> pd.DataFrame:
        own = [buckets(t, words, count) for t in texts]
        return pd.DataFrame({"n_words": [n for n, _ in own], "n_features": [len(b) for _, b in own], "buckets": [b.astype("<u2").tobytes() for _, b in own]})

    return docs.select(*keys, scan("text").alias("_scan")).select(*keys, "_scan.*")


def totals(rows: DataFrame, count: int = BUCKETS) -> np.ndarray:
    """How many features of `rows` lie in each bucket. Each task sends `count` sums at most."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(count, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                held += np.bincount(np.frombuffer(value.as_buffer(), dtype="<u2"), minlength=count)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], ["bucket", "n"])

    summed = rows.select("buckets").mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    result = np.zeros(count, dtype=np.int64)
    for bucket, n in summed.collect():  # `count` rows at most
        result[bucket] = n
    return result


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the log ratio of its smoothed shares of target and corpus, rounded down."""
    own, all_ = int(target.sum()) + len(target), int(corpus.sum()) + len(corpus)
    return np.array([math.floor(1000 * math.log(float((t + 1) * all_) / float((s + 1) * own))) for t, s in zip(target.tolist(), corpus.tolist(), strict=True)], dtype=np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A thousand times a Gumbel variate taken from the id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32)))).cast("long")


def weigh(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """`rows` of `features` with weight in place of the buckets. The gains are one number per bucket."""
    model = send(rows.sparkSession, gain)

    @F.pandas_udf("long")
    def weight(held: pd.Series) -> pd.Series:
        by_bucket = model()
        return pd.Series([int(by_bucket[np.frombuffer(b, dtype="<u2")].sum()) for b in held], dtype="int64")

    return rows.withColumn("weight", weight("buckets")).drop("buckets")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank for every document; rank is NULL where a document is not drawn."""
    rows = materialize(features(docs, ["doc_id"]), "features")
    gain = gains(totals(features(target, [])), totals(rows))
    scored = weigh(rows, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialize(scored, "scores")
    long_enough = scored.filter(F.col("n_words") >= least_words)
    drawn = percent * long_enough.count() // 100
    # The order's last key tells rows of one score and id apart, so that a hot id is dealt over many ranges.
    keyed = long_enough.select("doc_id", "n_features", "weight", "score", (-F.col("score")).alias("_down"), F.col("doc_id").isNull().alias("_last"))
    placed = with_position(keyed.withColumn("_row_id", F.monotonically_increasing_id()), ["_down", "_last", "doc_id", "_row_id"])
    rank = F.when(F.col("_position") <= drawn, F.col("_position")).cast("long")
    out = ["doc_id", "n_features", "weight", "score"]
    others = scored.filter(F.col("n_words") < least_words).select(*out, F.lit(None).cast("long").alias("rank"))
    return placed.select(*out, rank.alias("rank")).unionByName(others)
