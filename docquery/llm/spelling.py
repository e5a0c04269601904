"""Spelling variants: words one edit apart, found through an index of variable-length grams.

The words are padded with `^` and `$`. A dictionary holds the grams longer than
the shortest that are frequent, so a position opens a longer gram where shorter
ones would have long lists. At each position stands the longest gram of the
dictionary, or the shortest kind of gram; it is left out when a gram that begins
earlier reaches as far. One edit then changes only the grams whose window it
lies in, and later ones that the window covers. Their greatest number over all
places of a word is the word's bound: all its other grams stay.

Of a word's grams, rarest first, one more than its bound are its list heads. Two
words one edit apart have a head in common, at the same place, or one place on
in the longer word behind the edit. So merging the lists of heads by gram,
length and place loses no pair, and the long lists of common grams are never
merged. Pairs found are verified, first by their sets of letters, then by their
edit distance.

Sizes: the dictionary and the table of common grams hold at most `LIMIT` grams
per length, since a gram is taken in only above an even share of all of them.
Each is sent out whole; words, lists and pairs never are.

Cases: a NULL, empty or letterless text has no words. A NULL id counts as an
empty one. Repeated rows count as often as they stand there. An empty table
gives an empty result. Ties for the form go to the smaller word. Other columns are not
read, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.llm.shared import send
from docquery.session import materialize

#: Every 199th run loses a letter, which plants misspellings.
DAMAGE = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A form is at least so many times as frequent as its variant.
DOMINANCE = 5
SHORTEST = 3
LONGEST = 5
#: Grams of one length in the dictionary, and in the table of common grams.
LIMIT = 100_000
#: Distinct words a task holds before it passes their counts on.
HELD_WORDS = 200_000

#: A run that is too short gives no word, so it isn't looked at.
_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}")


def count_words(doc_id: str | None, text: str | None, held: Counter[str]) -> None:
    """Add the words of one text to `held`: its long runs, lower-cased and damaged as their ids and letters decide."""
    # bytes.lower changes A-Z only.
    runs = _RUN.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
    held.update(runs)
    begun = crc32(f"{doc_id or ''}:".encode())
    for run in set(runs):
        h = crc32(run.encode(), begun)
        if h % DAMAGE == 0:
            at, n = h % len(run), runs.count(run)
            held[run] -= n
            held[run[:at] + run[at + 1 :]] += n


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) for the words with at least `least` occurrences. Counts are summed in every task before they move."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["_id"], batch["_text"], strict=True):
                count_words(doc_id, text, held)
                if len(held) >= HELD_WORDS:
                    yield _frame(held)
                    held.clear()
        yield _frame(held)

    # The id as text: pandas would turn a column of whole numbers with NULLs into floats.
    rows = docs.select(F.col("doc_id").cast("string").alias("_id"), F.col("text").alias("_text"))
    counted = rows.mapInPandas(count, "word string, n long").filter(F.length("word") >= LEAST_LETTERS)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _frame(counts: Counter[str]) -> pd.DataFrame:
    return pd.DataFrame({"word": list(counts), "n": list(counts.values())}).astype({"word": "object", "n": "int64"})


def padded(word: str, longest: int = LONGEST) -> str:
    return "^" * (longest - 1) + word + "$" * (longest - 1)


def grams(word: str, frequent: set[str] | dict[str, int], shortest: int = SHORTEST, longest: int = LONGEST) -> list[tuple[int, str]]:
    """(place, gram) of the padded word: the longest known gram of each place, unless an earlier one reaches as far."""
    text = padded(word, longest)
    found, reached = [], 0
    for at in range(len(text) - shortest + 1):
        size = shortest
        while size < longest and at + size < len(text) and text[at : at + size + 1] in frequent:
            size += 1
        if at + size > reached:
            reached = at + size
            found.append((at, text[at:reached]))
    return found


def bound(found: list[tuple[int, str]], letters: int, longest: int = LONGEST) -> int:
    """How many of a word's grams one edit can change at most.

    An edit at place i may change every gram that begins in the `longest` places up to i, since it
    lies in their windows, and may cover or uncover later grams that end within that reach.
    """
    # A gram from `at` to `end` is changed by edits at places end - longest to at + longest - 1; count how many such stretches begin and end.
    turns = [0] * (letters + 3 * longest)
    for at, gram in found:
        turns[max(at + len(gram) - longest, 0)] += 1
        turns[at + longest] -= 1
    return max(accumulate(turns), default=0)


def letters(word: str) -> int:
    """A word's set of letters, folded into 63 bits. One edit takes at most one bit away and sets at most one."""
    held = 0
    for letter in set(word):
        held |= 1 << ord(letter) % 63
    return held


def heads(word: str, frequent: set[str], common: dict[str, int], shortest: int = SHORTEST, longest: int = LONGEST) -> list[tuple[int, str]]:
    """The grams whose lists the word is merged on: one more than its bound, rarest first."""
    found = grams(word, frequent, shortest, longest)
    order = sorted(found, key=lambda x: (common.get(x[1], 0), x[1], x[0]))
    return order[: bound(found, len(word), longest) + 1]


def _gram_counts(words: DataFrame, cut: Callable[[str], list[str]], above: int) -> dict[str, int]:
    """How often the grams that `cut` gives occur over all words, where that is more than `above`."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held: Counter[str] = Counter()
            for word in batch["word"]:
                held.update(cut(word))
            yield _frame(held)

    summed = words.select("word").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # No more than `LIMIT`, for `above` is an even share of all occurrences.
    return {r["word"]: r["n"] for r in summed.filter(F.col("n") > above).collect()}


def dictionary(words: DataFrame, places: int, shortest: int = SHORTEST, longest: int = LONGEST, limit: int = LIMIT) -> set[str]:
    """The grams of more than the shortest size that are frequent. Only those with a frequent beginning are counted."""
    above = places // limit
    frequent: set[str] = set()
    for size in range(shortest + 1, longest + 1):
        before = send(words.sparkSession, {g for g in frequent if len(g) == size - 1}) if size > shortest + 1 else None

        def cut(word: str, size: int = size, before=before) -> list[str]:
            text = padded(word, longest)
            all_ = [text[i : i + size] for i in range(len(text) - size + 1)]
            return all_ if before is None else [g for g in all_ if g[:-1] in before()]

        frequent |= set(_gram_counts(words, cut, above))
    return frequent


def pairs(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, limit: int = LIMIT) -> DataFrame:
    """(a, a_n, b, b_n), once for every two words of `words` (word, n) that are exactly one edit apart. `words` should be a written table."""
    spark = words.sparkSession
    places = words.agg(F.coalesce(F.sum(F.length("word") + 2 * (longest - 1)), F.lit(0))).first()[0]
    frequent = send(spark, dictionary(words, places, shortest, longest, limit))

    def cut(word: str) -> list[str]:
        return [gram for _, gram in grams(word, frequent(), shortest, longest)]

    common = send(spark, _gram_counts(words, cut, places // limit))

    def lists_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (word, n, letters(word), len(word), place, gram)
                for word, n in zip(batch["word"], batch["n"], strict=True)
                for place, gram in heads(word, frequent(), common(), shortest, longest)
            ]
            yield pd.DataFrame(rows, columns=["word", "n", "letters", "size", "place", "gram"])

    # Without a fixed number of tasks, a small table would be one task's work.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with_heads = words.select("word", "n").repartition(tasks, "word").mapInPandas(lists_of, "word string, n long, letters long, size int, place int, gram string")
    lists = materialize(with_heads, "lists")
    held = lists.select(F.xxhash64("gram", "size", "place").alias("list"), F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("letters").alias("b_letters"), F.col("size").alias("b_size"))
    # A word asks for words of its own length, and for those one letter shorter, where the gram stands in place or one place back.
    asked = F.array(*[F.struct((F.col("size") - less).alias("size"), (F.col("place") - back).alias("place")) for less, back in ((0, 0), (1, 0), (1, 1))])
    asking = lists.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("letters").alias("a_letters"), F.col("size").alias("a_size"), "gram", F.explode(asked).alias("asked"))
    asking = asking.select("a", "a_n", "a_letters", "a_size", F.xxhash64("gram", "asked.size", "asked.place").alias("list"))
    met = asking.join(
        held,
        (asking["list"] == held["list"])
        & ((F.col("a_size") > F.col("b_size")) | (F.col("a") < F.col("b")))
        & (F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2)
        & (F.levenshtein("a", "b", 1) == 1),
    )
    return met.select("a", "a_n", "b", "b_n").distinct()


def forms(words: DataFrame, near: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """word, n, n_near, form and form_n for every word: its most frequent near word, where that is frequent enough."""
    both = near.select(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word")).alias("other"))
    both = both.unionByName(near.select(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("n"), F.col("a").alias("word")).alias("other")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    taken = -F.col("best.n") >= dominance * F.col("n")
    return words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("best.word")).alias("form"),
        F.when(taken, -F.col("best.n")).alias("form_n"),
    )


def roots(formed: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, root) for the words with a form. `formed` should be a written table.

    Each round doubles the steps taken. A form is `dominance` times as frequent as its word, so the
    counts bound the length of a chain, and with it the rounds.
    """
    chain = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    least, most = formed.filter("form IS NOT NULL").agg(F.min("n"), F.max("form_n")).first()
    if least is None:
        return chain
    steps = math.floor(math.log(most / least, dominance) + 1e-9)
    for _ in range(math.ceil(math.log2(max(steps, 1)))):
        chain = materialize(chain, "roots")
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        chain = chain.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
    return chain


def variants(docs: DataFrame, least: int = LEAST_COUNT, dominance: int = DOMINANCE) -> DataFrame:
    """word, form, root, n, n_near and form_n for every word of `docs` (doc_id, text)."""
    words = materialize(vocabulary(docs, least), "words")
    near = materialize(pairs(words), "near")
    formed = materialize(forms(words, near, dominance), "forms")
    followed = formed.join(roots(formed, dominance), "word", "left")
    return followed.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
