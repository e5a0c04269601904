"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

Each block has features of its ancestors (tags, words of class, id and role) and of
its text (length, share of links, end mark, cue words). The field scores each label
of a block by its features and each pair of neighbouring labels; it is trained on
labelled pages by gradient ascent on their likelihood, and Viterbi finds the best
labels of a page.

Cases: a NULL, empty or blank page has no text. Repeated rows are extracted each.
A page that breaks off is read as far as it goes. Very long pages are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.llm.html_blocks import Block, blocks
from docquery.llm.html_pages import labelled_pages
from docquery.llm.shared import send

CUES = frozenset(
    "cookie cookies subscribe newsletter copyright rights reserved privacy terms share follow comments comment reply login advertisement sponsored search menu ©".split()
)
STEPS = 400
RATE = 0.1
PENALTY = 1e-4


def _bucket(value: float, edges: Iterable[float]) -> int:
    return sum(value >= e for e in edges)


def features(block: Block) -> list[str]:
    text, tags = block.text, block.tags
    words = text.count(" ") + 1
    own = tags[-1] if tags else ""
    out = [f"in {t}" for t in set(tags)]
    out += [f"name {n}" for n in block.names]
    out += [
        "any",
        f"tag {own}",
        f"words {_bucket(words, (2, 5, 10, 25, 60))}",
        f"links {_bucket(block.link_chars / len(text), (0.01, 0.34, 0.67))}",
        f"ends {text[-1] in '.!?'}",
        f"commas {_bucket(text.count(','), (1, 4))}",
    ]
    if words < 25:
        out += [f"cue {w}" for w in {w.strip(".,:!?") for w in text.lower().split()} & CUES]
    return out


@dataclass
class Field:
    """Weights: of each feature for "main text" against "other", of neighbouring labels, of the first label."""

    weights: dict[str, float]
    moves: list[list[float]]
    first: list[float]

    def labels(self, page: list[Block]) -> list[int]:
        """The most likely labels of all blocks together (Viterbi)."""
        if not page:
            return []
        get, moves = self.weights.get, self.moves
        best: list[float] = []
        back: list[tuple[int, int]] = []
        for i, block in enumerate(page):
            score = sum([get(f, 0.0) for f in features(block)])
            if not i:
                best = [self.first[0], self.first[1] + score]
                continue
            from0, from1 = (best[0] + moves[0][0], best[1] + moves[1][0]), (best[0] + moves[0][1], best[1] + moves[1][1])
            back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
            best = [max(from0), max(from1) + score]
        out = [int(best[1] > best[0])]
        for pointers in reversed(back):
            out.append(pointers[out[-1]])
        return out[::-1]

    def text(self, page: str | None) -> str:
        found = list(blocks(page))
        return "\n".join(b.text for b, label in zip(found, self.labels(found), strict=True) if label)


def train(pages: list[tuple[str, list[int]]], steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> Field:
    """Fit on pages with the labels of their leaf blocks; all pages take a step together (Adam)."""
    found = [(list(blocks(page)), labels) for page, labels in pages]
    for own, labels in found:
        if len(own) != len(labels):
            raise ValueError("a page needs one label for each of its leaf blocks")
    found = [(own, labels) for own, labels in found if own]
    if not found:
        return Field({}, [[0.0, 0.0], [0.0, 0.0]], [0.0, 0.0])
    names: dict[str, int] = {}
    rows = [[names.setdefault(f, len(names)) for f in features(b)] for own, _ in found for b in own]
    x = np.zeros((len(rows), len(names)))
    for i, row in enumerate(rows):
        x[i, row] = 1.0
    lengths = np.array([len(own) for own, _ in found])
    y = np.concatenate([labels for _, labels in found])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    longest = int(lengths.max())
    at = starts[:, None] + np.minimum(np.arange(longest), (lengths - 1)[:, None])
    inside = np.arange(longest) < lengths[:, None]

    seen_moves = np.zeros((2, 2))
    for own, labels in found:
        for a, b in zip(labels, labels[1:], strict=False):
            seen_moves[a, b] += 1
    seen_first = np.bincount(y[starts], minlength=2).astype(float)

    theta = np.zeros(len(names) + 6)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, moves, first = theta[: len(names)], theta[len(names) : -2].reshape(2, 2), theta[-2:]
        unary = np.zeros((len(rows), 2))
        unary[:, 1] = x @ w
        scores = unary[at]  # pages, places, labels
        forward = np.zeros((len(found), longest, 2))
        forward[:, 0] = first + scores[:, 0]
        for t in range(1, longest):
            step_in = np.logaddexp(forward[:, t - 1, :1] + moves[0], forward[:, t - 1, 1:] + moves[1]) + scores[:, t]
            forward[:, t] = np.where(inside[:, t, None], step_in, forward[:, t - 1])
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        backward = np.zeros_like(forward)
        expected_moves = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            ahead = backward[:, t + 1] + scores[:, t + 1]
            here = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
            use = inside[:, t + 1, None]
            joint = np.exp(forward[:, t, :, None] + moves + ahead[:, None, :] - total[:, None, None])
            expected_moves += (joint * use[..., None]).sum(axis=0)
            backward[:, t] = np.where(use, here, backward[:, t + 1])
        likely = np.exp(forward + backward - total[:, None, None])
        expected = np.zeros(len(rows))
        expected[at[inside]] = likely[..., 1][inside]
        gradient = np.concatenate(
            [x.T @ (y - expected), (seen_moves - expected_moves).ravel(), seen_first - likely[:, 0].sum(axis=0)]
        ) / len(rows) - penalty * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta = theta + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Field(
        {f: float(theta[i]) for f, i in names.items()}, theta[len(names) : -2].reshape(2, 2).tolist(), theta[-2:].tolist()
    )


def default_field() -> Field:
    return train(labelled_pages())


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    sent = send(pages.sparkSession, field)

    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        read = sent().text
        return pd.Series([read(p) for p in pages], dtype=object)

    return pages.select("page_id", "url", text("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
