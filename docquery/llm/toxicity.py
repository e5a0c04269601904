"""Toxicity of documents from a lexicon, misspellings included, and the context of each find.

The lexicon is learned: terms whose occurrences stand in many different contexts
of toxic training texts and hardly in others. Contexts are counted, not
occurrences, so that copies of one text add nothing. The terms form a trie;
walking it together with a Levenshtein automaton finds every term within the
allowed edits of a word. States (sets of trie nodes with the edits spent) and
their moves are built when first met, so a word costs one look-up per character
and most words end after a few.

Every find is weighed by the words around it: within quotation marks, or after a
reporting word, it speaks about the term and counts for little; next to a word
that addresses someone it counts for more. A logistic regression over these sums
gives the score.

Cases: a NULL or empty text has no finds and gets the score of none. Without
labelled rows of both classes every score is 0. Equal texts have equal scores.
Rows without an id are scored too; they are never held out and never trained on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.llm import logistic
from docquery.llm.shared import send
from docquery.llm.tables import held_out, label_counts, labelled_sample
from docquery.session import materialize

#: Labelled training rows of each class that the lexicon and the weights are learned from.
SAMPLE_PER_CLASS = 4000
#: A term's G statistic, and its rate in toxic texts over that in others, must reach these.
LEAST_EVIDENCE = 30.0
LEAST_RATIO = 20.0
#: Words around a find that are looked at.
CONTEXT = 6
QUOTED = 0.1
ADDRESSED = 1.5
THRESHOLD = 0.5
REMEMBERED = 200_000

REPORTING = frozenset(
    "said says wrote writes quoted quote called calling word term sagte schrieb nannte wort zitat dit écrit appelé mot citation dijo escribió llamó palabra cita".split()
)
ADDRESS = frozenset("you your youre u du dich dir dein euch ihr tu te toi ton vous tú ti usted vosotros".split())

_WORD = re.compile(r"\w+")
_OPEN, _CLOSE = "“«„‹", "”»“›"


def edits_allowed(length: int) -> int:
    return 0 if length < 4 else 1 if length < 10 else 2


class Trie:
    """The terms by their characters; each node knows the most edits of the terms below it."""

    def __init__(self, terms):
        self.children: list[dict[str, int]] = [{}]
        self.allowed: list[int] = [0]
        self.term: list[str | None] = [None]
        for term in terms:
            edits, node = edits_allowed(len(term)), 0
            self.allowed[0] = max(self.allowed[0], edits)
            for ch in term:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                    self.term.append(None)
                node = self.children[node][ch]
                self.allowed[node] = max(self.allowed[node], edits)
            self.term[node] = term


class Automaton:
    """The trie walked with all spellings within the allowed edits, one state per set of (node, edits)."""

    def __init__(self, terms):
        self.trie = Trie(sorted(set(terms)))
        self.reset()

    def reset(self) -> None:
        self.moves: dict[tuple[int, str], int] = {}
        self.states: list[dict[int, int]] = []
        self.numbers: dict[frozenset, int] = {}
        self.ends: list[int] = []
        self.start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """The number of the state of these nodes, each with the fewest edits; missing characters are skipped for free steps."""
        trie, todo = self.trie, list(reached.items())
        while todo:
            node, edits = todo.pop()
            if reached.get(node, 99) < edits:
                continue
            for child in trie.children[node].values():
                if edits + 1 <= trie.allowed[child] and reached.get(child, 99) > edits + 1:
                    reached[child] = edits + 1
                    todo.append((child, edits + 1))
        key = frozenset(reached.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(dict(reached))
            fits = [e for n, e in reached.items() if trie.term[n] is not None and e <= edits_allowed(len(trie.term[n]))]
            self.ends.append(min(fits, default=-1))
        return self.numbers[key]

    def _move(self, state: int, ch: str) -> int:
        trie, reached = self.trie, {}

        def reach(node: int, edits: int) -> None:
            if edits <= trie.allowed[node] and reached.get(node, 99) > edits:
                reached[node] = edits

        for node, edits in self.states[state].items():
            reach(node, edits + 1)  # a character too many
            for own, child in trie.children[node].items():
                reach(child, edits + (own != ch))
        return self._state(reached) if reached else -1

    def edits(self, word: str) -> int:
        """The fewest edits to a term that allows them, or -1."""
        if len(self.moves) > REMEMBERED:
            self.reset()
        state = self.start
        for ch in word:
            following = self.moves.get((state, ch))
            if following is None:
                following = self.moves[state, ch] = self._move(state, ch)
            if following < 0:
                return -1
            state = following
        return self.ends[state]


class _Known(dict):
    """Edits of words met before."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = self.automaton.edits(word)
        return value


@dataclass
class Lexicon:
    terms: list[str]
    known: _Known = field(init=False)

    def __post_init__(self):
        self.known = _Known(Automaton(self.terms))

    def finds(self, text: str) -> Iterator[tuple[int, int, int, float]]:
        """(start, end, edits, context weight) of every word that is a term or close to one."""
        lower = text.lower()
        edits = list(map(self.known.__getitem__, _WORD.findall(lower)))
        if max(edits, default=-1) < 0:
            return
        spans = [m.span() for m in _WORD.finditer(lower)]
        for i, n in enumerate(edits):
            if n >= 0:
                yield *spans[i], n, context_weight(lower, spans, i)

    def features(self, text: str | None) -> list[float]:
        """Weighed finds: exact, misspelled, quoted; and the first two per hundred words."""
        exact = close = quoted = 0.0
        for _, _, edits, weight in self.finds(text or ""):
            if weight <= QUOTED:
                quoted += 1
            elif edits:
                close += weight
            else:
                exact += weight
        if not (exact or close or quoted):
            return [0.0] * 6
        words = len(_WORD.findall(text))
        return [float(exact > 0), math.log1p(exact), math.log1p(close), math.log1p(quoted), math.log1p(100 * exact / words), math.log1p(100 * close / words)]


def context_weight(text: str, spans: list[tuple[int, int]], i: int, context: int = CONTEXT) -> float:
    """How much a find counts: little where it is quoted or reported, more where someone is addressed."""
    first, last = max(0, i - context), min(len(spans) - 1, i + context)
    before, after = text[spans[first][0] : spans[i][0]], text[spans[i][1] : spans[last][1] + 1]
    if before.count('"') % 2 and '"' in after:
        return QUOTED
    opened = max(before.rfind(c) for c in _OPEN)
    if opened >= 0 and not any(c in before[opened + 1 :] for c in _CLOSE) and any(c in after for c in _CLOSE):
        return QUOTED
    if any(text[s:e] in REPORTING for s, e in spans[first:i]):
        return QUOTED
    near = [text[s:e] for s, e in spans[first : last + 1]]
    return ADDRESSED if any(w in ADDRESS for w in near) else 1.0


def learn_terms(sample: DataFrame, evidence: float = LEAST_EVIDENCE, ratio: float = LEAST_RATIO) -> list[str]:
    """Terms of the toxic texts of `sample` (doc_id, text, label). The bounded sample and the evidence asked for bound their number."""

    def contexts(batches):
        for batch in batches:
            rows = set()
            for text, label in zip(batch["text"], batch["label"], strict=True):
                found = _WORD.findall(text.lower())
                for before, word, after in zip(["", *found], found, [*found[1:], ""], strict=False):
                    rows.add((word, f"{before} {after}", int(label)))
            yield pd.DataFrame(list(rows), columns=["word", "context", "label"])

    rows = sample.mapInPandas(contexts, "word string, context string, label int").distinct()
    counted = rows.groupBy("word").agg(
        F.sum(F.col("label").cast("double")).alias("pos"), F.sum(1 - F.col("label").cast("double")).alias("neg")
    )
    counted = materialize(counted, "terms")
    toxic, other = counted.agg(F.sum("pos"), F.sum("neg")).first()
    if not toxic or not other:
        return []
    share = toxic / (toxic + other)
    n = F.col("pos") + F.col("neg")
    neg = F.when(F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") / (n * (1 - share)))).otherwise(0.0)
    scored = counted.filter("pos > 0").withColumn("g", 2 * (F.col("pos") * F.log(F.col("pos") / (n * share)) + neg))
    rate = (F.col("pos") / toxic) / ((F.col("neg") + 0.5) / other)
    kept = scored.filter((F.col("g") >= evidence) & (rate >= ratio)).orderBy(F.desc("g"), "word")
    return [r["word"] for r in kept.select("word").collect()]


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray | None

    def score(self, texts) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        x = np.array([self.lexicon.features(t) for t in texts], dtype=float).reshape(-1, 6)
        return logistic.sigmoid(x @ self.weights[:-1] + self.weights[-1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Learn from a bounded sample.

    The weights come from one half of it, with the lexicon of the other half, so
    that finds are as reliable there as in new texts. The lexicon that is then
    used comes from all of it; where half of the sample is too little evidence for
    any term, the weights come with that lexicon too.
    """
    sample = materialize(labelled_sample(docs, labels, "toxic", per_class), "toxic-sample")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    lexicon = Lexicon(learn_terms(sample))
    terms = learn_terms(sample.filter(half == 0)) or lexicon.terms
    sent = send(docs.sparkSession, Lexicon(terms))

    def features(batches):
        for batch in batches:
            own = sent()
            yield pd.DataFrame({"label": batch["label"], "x": [own.features(t) for t in batch["text"]]})

    rows = sample.filter(half == 1).mapInPandas(features, "label int, x array<double>").toPandas()
    y = rows["label"].to_numpy(float)
    if not terms or len(set(y)) < 2:
        return Model(lexicon, None)
    x = np.array(rows["x"].tolist(), dtype=float)
    return Model(lexicon, logistic.fit(x, y, logistic.class_weights(y, label_counts(labels, "toxic"))))


def score_column(spark: SparkSession, model: Model) -> Column:
    sent = send(spark, model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(sent().score(texts))

    return score


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = docs.select("doc_id", score_column(docs.sparkSession, model)("text").alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not toxic, with their own columns."""
    return docs.filter(score_column(docs.sparkSession, model)("text") < THRESHOLD)
