"""Quality of documents by a support vector machine over naive Bayes features.

Features are indicators of character n-grams, hashed. Each is scaled by the log
ratio of its smoothed frequencies among good and poor training texts; texts are
normalized to length one; dual coordinate descent fits a linear model with hinge
loss. Margins of texts that a model was not fitted on give the curve that turns
margins into probabilities, at the classes' shares among all labelled rows.

Cases: a NULL or empty text has no n-grams and gets the score of the constant
alone. Without labelled rows of both classes every score is 1. Equal texts have
equal scores. Rows without an id are scored too, never held out, never trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.llm import logistic
from docquery.llm.shared import send
from docquery.llm.tables import held_out, label_counts, labelled_sample

#: Labelled training rows of each class that the model is fitted on.
SAMPLE_PER_CLASS = 2000
SIZES = (1, 2, 3, 4)
SHAPE_SIZES = (2, 4, 6, 8)
BITS = 18
THRESHOLD = 0.3
#: Bound of the dual variables, and passes over the training rows.
COST = 1.0
PASSES = 12


def _classes() -> np.ndarray:
    """For each byte: one letter for lower case and all beyond ASCII, one for upper case, digits and white space each; others themselves."""
    table = np.arange(256, dtype=np.uint8)
    table[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = ord("a")
    table[ord("A") : ord("Z") + 1] = ord("A")
    table[ord("0") : ord("9") + 1] = ord("0")
    table[list(b" \t\r\f\v")] = ord(" ")
    return table


_CLASS = _classes()
_RUNS = np.isin(np.arange(256), np.frombuffer(b"aA0 ", dtype=np.uint8))


def _mark(flags: np.ndarray, raw: np.ndarray, sizes: tuple[int, ...], salt: int) -> None:
    code = np.zeros(len(raw), dtype=np.uint64)
    for n in range(1, max(sizes) + 1):
        if len(raw) < n:
            return
        code = (code[: len(raw) - n + 1] << np.uint64(8)) | raw[n - 1 :]
        if n in sizes:
            mixed = (code + np.uint64(salt + n)) * np.uint64(0x9E3779B97F4A7C15)
            flags[(mixed >> np.uint64(64 - BITS)).astype(np.int64)] = True


def grams(text: str | None) -> np.ndarray:
    """Numbers of the n-grams of a text, sorted, each once.

    There are n-grams of its characters, n-grams of its shape (characters by class,
    runs of one class as one), and one for how large a part of the words repeat the
    word before.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data, dtype=np.uint8)
    flags = np.zeros(1 << BITS, dtype=bool)
    if len(raw):
        _mark(flags, raw.astype(np.uint64), SIZES, 0)
        shape = _CLASS[raw]
        kept = np.ones(len(shape), dtype=bool)
        kept[1:] = (shape[1:] != shape[:-1]) | ~_RUNS[shape[1:]]
        _mark(flags, shape[kept].astype(np.uint64), SHAPE_SIZES, 100)
        words = data.split()
        again = sum(map(eq, words, words[1:]))
        part = np.array([min(again, 3), 10 * again // max(len(words), 1)], dtype=np.uint64)
        _mark(flags, part, (2,), 200)
    return np.flatnonzero(flags).astype(np.int32)


def log_ratios(rows: list[np.ndarray], good: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Log ratio of each n-gram's smoothed share among good and among poor texts."""
    counts = np.full((2, 1 << BITS), smooth)
    for row, y in zip(rows, good, strict=True):
        counts[int(y > 0), row] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


@dataclass
class Machine:
    """A linear model on scaled indicators: `pull` = weight * ratio, `norm` = ratio squared."""

    pull: np.ndarray
    norm: np.ndarray
    constant: float

    def margin(self, row: np.ndarray) -> float:
        length = float(self.norm[row].sum()) ** 0.5
        return (float(self.pull[row].sum()) / length if length else 0.0) + self.constant


def fit(rows: list[np.ndarray], good: np.ndarray, cost: float = COST, passes: int = PASSES, seed: int = 7) -> Machine:
    """Dual coordinate descent for hinge loss; `good` is 1 or -1, and the constant is one more feature of value 1."""
    ratio = log_ratios(rows, good)
    values = []
    for row in rows:
        own = ratio[row]
        length = float(np.sqrt(own @ own))
        values.append(own / length if length else own)
    squares = np.array([float(v @ v) + 1.0 for v in values])
    weight, constant, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    random = np.random.default_rng(seed)
    for _ in range(passes):
        for i in random.permutation(len(rows)):
            gradient = good[i] * (float(weight[rows[i]] @ values[i]) + constant) - 1.0
            moved = min(max(alpha[i] - gradient / squares[i], 0.0), cost)
            step = (moved - alpha[i]) * good[i]
            if step:
                alpha[i] = moved
                weight[rows[i]] += step * values[i]
                constant += step
    return Machine(weight * ratio, ratio * ratio, constant)


@dataclass
class Model:
    machine: Machine | None
    curve: np.ndarray | None

    def score(self, texts) -> np.ndarray:
        if self.machine is None:
            return np.ones(len(texts))
        margins = np.array([self.machine.margin(grams(t)) for t in texts], dtype=float)
        return logistic.sigmoid(self.curve[0] * margins + self.curve[1])


def fit_all(rows: list[np.ndarray], y: np.ndarray, shares: dict[int, int]) -> Model:
    """The machine of all rows, and the curve that turns margins into scores, from margins of rows a machine has not seen."""
    if len(set(y)) < 2 or min(np.bincount(y)) < 2:
        return Model(None, None)
    good = np.where(y == 1, 1.0, -1.0)
    # Every other row of each class is in the same half.
    half = np.zeros(len(y), dtype=int)
    for value in (0, 1):
        own = np.flatnonzero(y == value)
        half[own] = np.arange(len(own)) % 2
    margins = np.zeros(len(y))
    for part in (0, 1):
        inside, outside = np.flatnonzero(half == part), np.flatnonzero(half != part)
        machine = fit([rows[i] for i in inside], good[inside])
        margins[outside] = [machine.margin(rows[i]) for i in outside]
    curve = logistic.fit(margins[:, None], y.astype(float), logistic.class_weights(y, shares))
    return Model(fit(rows, good), curve)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on a bounded sample, in one task of an executor; the driver gets the finished model only.

    A row of the sample has at most `2 ** BITS` numbers, however long its text is.
    """
    sample = labelled_sample(docs, labels, "quality", per_class)
    shares = label_counts(labels, "quality")

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "row": [grams(t).tobytes() for t in batch["text"]]})

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = pd.concat([pd.DataFrame({"doc_id": [], "label": [], "row": []}), *batches]).sort_values(["doc_id", "label"])
        model = fit_all([np.frombuffer(r, dtype=np.int32) for r in found["row"]], found["label"].to_numpy(int), shares)
        if (own := model.machine) is not None:
            yield pd.DataFrame({"pull": [own.pull.tobytes()], "norm": [own.norm.tobytes()], "constant": [own.constant], "curve": [model.curve.tobytes()]})

    rows = sample.mapInPandas(featured, "doc_id long, label int, row binary").repartition(1)
    made = rows.mapInPandas(fitted, "pull binary, norm binary, constant double, curve binary").first()
    if made is None:
        return Model(None, None)
    pull, norm, curve = (np.frombuffer(made[c], dtype=np.float64) for c in ("pull", "norm", "curve"))
    return Model(Machine(pull, norm, made["constant"]), curve)


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


def good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents of sufficient quality, with their own columns."""
    return docs.filter(score_column(docs.sparkSession, model)("text") >= THRESHOLD)
