"""Packing token sequences of documents into fixed-length training sequences.

A document becomes its token ids and an end mark; one that is longer than a
sequence is cut into full pieces, the first of which may be shorter. How pieces
share sequences depends on their lengths alone: the histogram of lengths, which
has at most as many entries as a sequence has tokens, gives a linear program with
a variable for every configuration (multiset of lengths that fits). Multiplicative
weights solve it: a length's weight falls as configurations cover it, and knapsack
dynamic programming finds the configurations of the highest weight. Counts are
rounded down; what is left over goes to the fullest sequence that has room, length
by length from the longest. All that runs on the histogram. The plan lists runs:
"pieces of length l with ranks from..to lie in sequences from.. at offset ..". Pieces
are numbered within their length by Spark, and look their place up in the runs.

Cases: a NULL or empty text is the end mark alone. Repeated documents are packed
each. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.llm.numbering import ROWS_PER_GROUP, groups, numbered
from docquery.llm.shared import send
from docquery.session import materialize

SEQUENCE = 1024
END_ID = 2
#: Characters outside Latin script and common marks.
LATIN = "[^\x00-\u024f\u2010-\u2027]"
PIECE = "struct<piece:int,start:long,length:long,ids_crc32:long>"


class Encoder:
    """Token ids of texts by a tokenizer of the `tokenizers` library.

    Given the same vocabulary as ranks and the pattern of its parts, texts in Latin
    script go through `tiktoken`, which gives the same ids several times faster.
    Texts with the tokenizer's special strings, or with characters on whose classes
    the two libraries might differ, stay with the tokenizer itself.
    """

    def __init__(self, tokenizer_json: str, ranks: str | None = None, pattern: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.other = re.compile("|".join([LATIN, *special]))
        self.fast = None
        if ranks and pattern:
            import tiktoken

            pairs = (line.split() for line in ranks.splitlines() if line)
            vocabulary = {base64.b64decode(token): int(rank) for token, rank in pairs}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit numbers of this machine: little-endian on all that Spark runs on."""
        if self.fast is None or self.other.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).tobytes()


def cut(length: int, sequence: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    if length <= sequence:
        return [(0, length)]
    first = length % sequence
    return ([(0, first)] if first else []) + [(s, sequence) for s in range(first, length, sequence)]


@dataclass
class TokenizerFiles:
    """Where a tokenizer lies: its JSON file and, to speed it up, the same vocabulary as ranks with its pattern."""

    tokenizer: str
    ranks: str | None = None
    pattern: str | None = None

    def read(self) -> _Lazy:
        ranks = Path(self.ranks).read_text(encoding="utf-8") if self.ranks else None
        return _Lazy(Path(self.tokenizer).read_text(encoding="utf-8"), ranks, self.pattern)


class _Lazy:
    """Builds the encoder where it is used: a tokenizer is sent as the text of its files, a few MB."""

    def __init__(self, *parts: str | None):
        self.parts = parts
        self.encoder: Encoder | None = None

    def get(self) -> Encoder:
        if self.encoder is None:
            self.encoder = Encoder(*self.parts)
        return self.encoder


def pieces(docs: DataFrame, files: TokenizerFiles, sequence: int = SEQUENCE, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece; with `ids` also the ids themselves."""
    encoder = send(docs.sparkSession, files.read())
    end = int(end_id).to_bytes(4, "little")

    def of(encoded: bytes) -> list[dict]:
        out = []
        for i, (start, length) in enumerate(cut(len(encoded) // 4, sequence)):
            part = encoded[4 * start : 4 * (start + length)]
            row = {"piece": i, "start": start, "length": length, "ids_crc32": zlib.crc32(part)}
            if ids:
                row["ids"] = array("I", part).tolist()
            out.append(row)
        return out

    kind = PIECE if not ids else PIECE[:-1] + ",ids:array<long>>"

    @F.pandas_udf(f"array<{kind}>")
    def encode(texts: pd.Series) -> pd.Series:
        encode = encoder().get().encode
        return pd.Series([of(encode(t or "") + end) for t in texts])

    return docs.select("doc_id", F.explode(encode("text")).alias("p")).select("doc_id", "p.*")


def price(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each capacity, and the length (its index, or -1 for none) to take first there."""
    best = np.zeros(capacity + 1)
    take = np.full(capacity + 1, -1, dtype=np.int64)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        k = upto[c]
        if not k:
            continue
        total = values[:k] + best[c - lengths[:k]]
        i = int(total.argmax())
        if total[i] > best[c - 1]:
            best[c], take[c] = total[i], i
        else:
            best[c], take[c] = best[c - 1], -2
    return best, take


def configuration(first: int, lengths: np.ndarray, take: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset {index: times} that `take` gives after one of index `first`."""
    out = {first: 1}
    c = capacity - int(lengths[first])
    while c > 0:
        i = int(take[c])
        if i == -1:
            break
        if i == -2:
            c -= 1
            continue
        out[i] = out.get(i, 0) + 1
        c -= int(lengths[i])
    return out


def solve(counts: dict[int, int], capacity: int, rate: float = 0.5, fraction: float = 0.25, per_price: int = 24) -> list[tuple[dict[int, int], float]]:
    """Configurations {length: times} and how often each is used, covering all counts (fractionally).

    Weights begin a little steeper than the lengths, since long pieces are harder
    to place, and fall by exp(-rate * share) as a share of a length is covered. A
    covered length leaves the pricing. One pricing yields several configurations:
    those that begin with the lengths of the best total value.
    """
    lengths = np.array(sorted(counts), dtype=np.int64)
    demand = np.array([counts[int(x)] for x in lengths], dtype=float)
    left = demand.copy()
    weights = (lengths / capacity) ** 1.1
    used: dict[tuple, float] = {}
    while len(active := np.flatnonzero(left > 0.5)):
        own, values = lengths[active], weights[active]
        best, take = price(own, values, capacity)
        total = values + best[capacity - own]
        order = np.argsort(-total, kind="stable")[:per_price]
        for first in order[total[order] >= 0.999 * total.max()]:
            chosen = configuration(int(first), own, take, capacity)
            at = active[list(chosen)]
            times = np.array(list(chosen.values()), dtype=float)
            share = float((left[at] / times).min())
            step = share if share < 4 else fraction * share
            if step <= 0:
                continue
            left[at] -= step * times
            weights[at] *= np.exp(-rate * step * times / demand[at])
            key = tuple(sorted((int(own[i]), n) for i, n in chosen.items()))
            used[key] = used.get(key, 0.0) + step
    return [(dict(k), x) for k, x in used.items()]


def plan(counts: dict[int, int], capacity: int = SEQUENCE) -> list[tuple[dict[int, int], int]]:
    """Configurations and whole numbers of sequences that hold exactly `counts` pieces of each length."""
    left = {length: n for length, n in counts.items() if n > 0}
    room: dict[int, list[list]] = {}  # free tokens: [configuration, sequences]
    full: list[tuple[dict[int, int], int]] = []

    def add(config: dict[int, int], times: int) -> None:
        free = capacity - sum(length * n for length, n in config.items())
        if free:
            room.setdefault(free, []).append([config, times])
        else:
            full.append((config, times))

    if capacity in left:
        full.append(({capacity: 1}, left.pop(capacity)))
    for config, x in sorted(solve(left, capacity), key=lambda cx: -cx[1]) if left else []:
        times = min([int(x + 1e-6), *(left[length] // n for length, n in config.items())])
        if times > 0:
            for length, n in config.items():
                left[length] -= n * times
            add(config, times)
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            free = min((f for f in room if f >= length), default=None)
            if free is None:
                each = min(capacity // length, n)
                add({length: each}, n // each)
                n %= each
                continue
            config, times = room[free].pop()
            if not room[free]:
                del room[free]
            moved = min(n, times)
            if times > moved:
                room.setdefault(free, []).append([config, times - moved])
            add({**config, length: config.get(length, 0) + 1}, moved)
            n -= moved
    return full + [(config, times) for kind in room.values() for config, times in kind]


def runs(sequences: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """One row per length and configuration: first rank, pieces in each sequence, first sequence, offset."""
    rows, ranks, first = [], {}, 0
    for config, times in sequences:
        offset = 0
        for length in sorted(config, reverse=True):
            each = config[length]
            rank = ranks.get(length, 0)
            rows.append((length, rank, each, first, offset))
            ranks[length] = rank + each * times
            offset += each * length
        first += times
    return pd.DataFrame(rows, columns=["length", "rank", "each", "sequence", "offset"])


def pack(docs: DataFrame, files: TokenizerFiles, sequence: int = SEQUENCE, end_id: int = END_ID, per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    rows = pieces(docs.select("doc_id", "text"), files, sequence, end_id)
    # Rows of one id, repeated ones too, are told apart by where they stand.
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    # At most one row per possible length.
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    place = send(spark, _Places(runs(plan(counts, sequence))))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        return place().of(lengths.to_numpy(), ranks.to_numpy())

    group = F.pmod(F.xxhash64("_row"), F.lit(groups(rows.count(), per_group)))
    ranked = numbered(rows, ["length"], group, ["doc_id", "piece", "ids_crc32"], "rank")
    out = ranked.withColumn("_at", placed("length", "rank"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset")


class _Places:
    """Finds the place of a piece by its length and rank."""

    def __init__(self, table: pd.DataFrame):
        table = table.sort_values(["length", "rank"])
        # One sorted key for both: ranks lie far below the step between lengths.
        self.step = 1 << 48
        self.keys = table["length"].to_numpy(np.int64) * self.step + table["rank"].to_numpy(np.int64)
        self.rank, self.each, self.sequence, self.offset = (table[c].to_numpy(np.int64) for c in ("rank", "each", "sequence", "offset"))

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> pd.DataFrame:
        i = np.searchsorted(self.keys, lengths * self.step + ranks, "right") - 1
        inner = ranks - self.rank[i]
        return pd.DataFrame(
            {"sequence_id": self.sequence[i] + inner // self.each[i], "offset": self.offset[i] + inner % self.each[i] * lengths}
        )
