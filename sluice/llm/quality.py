"""Quality by a generalised additive model with pairwise interactions.

Documents are described by a few numbers, each cut into bins. Boosting goes round the
features; each turn fits one shallow tree to what is still missed and adds it to that
feature's table of one value per bin. Afterwards the pairs of features that explain most
of the rest get tables of their own in the same way. A score is a sum of table look-ups.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import doc_texts, label_sample, text_slices
from sluice.session import stage

SAMPLE = 20_000  # labelled documents learned from at most
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 150
PAIR_ROUNDS = 50
RATE = 0.1
SHRINK = 5.0  # added to a leaf's weight
THRESHOLD = 0.7
FEATURES = ("words", "word_length", "lines", "line_words", "upper", "digits", "marks", "bars",
            "odd_marks", "exclaims", "distinct_words", "repeated_lines", "top_word", "short_words",
            "blanks", "lower")
_ODD = re.compile(r"[#$%&*<>{}\[\]\\^~|=+@]")
_MARK = re.compile(r"[^\w\s]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LOWER = re.compile(r"[a-zß-öø-ÿ]")
_DIGIT = re.compile(r"\d")


def describe(text: str | None) -> list[float]:
    """The features of one whole text; all zero for an empty one."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), len(text)
    lines = text.split("\n")
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    word_chars = sum(map(len, words))
    return [
        np.log1p(n), word_chars / n, np.log1p(len(lines)), np.log1p(n / len(lines)),
        len(_UPPER.findall(text)) / chars, len(_DIGIT.findall(text)) / chars,
        len(_MARK.findall(text)) / chars, text.count("|") / n, len(_ODD.findall(text)) / chars,
        text.count("!") / n, len(counts) / n, 1 - len(set(lines)) / len(lines),
        max(counts.values()) / n, sum(len(w) <= 3 for w in words) / n,
        1 - word_chars / chars, len(_LOWER.findall(text)) / chars]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in text_slices(batch):
            table = np.array([describe(t) for t in texts], dtype=np.float32).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c) for c in table.T.copy())],
                names=["doc_id", *FEATURES])


def features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the features of every row."""
    schema = ", ".join(["doc_id long", *(f"{f} float" for f in FEATURES)])
    return doc_texts(docs).mapInArrow(_described, schema)


@dataclass
class Model:
    edges: list[np.ndarray]
    pair_edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    bias: float = 0.0

    def raw(self, table: np.ndarray) -> np.ndarray:
        """Sum of the look-ups of each row of features."""
        bins = [np.searchsorted(e, c, side="right") for e, c in zip(self.edges, table.T)]
        coarse = [np.searchsorted(e, c, side="right") for e, c in zip(self.pair_edges, table.T)]
        out = np.full(len(table), self.bias)
        for t, b in zip(self.tables, bins):
            out += t[b]
        for i, j, t in self.pairs:
            out += t[coarse[i], coarse[j]]
        return out

    def score(self, table: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(table), -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` cuts between values, evenly over the rows."""
    return np.unique(np.quantile(column, np.arange(1, bins) / bins)) if len(column) else np.zeros(0)


def _cut(grad: np.ndarray, weight: np.ndarray) -> tuple[int, float]:
    """Best place to cut a run of bins in two, and what the cut gains; place 0: none."""
    if len(grad) < 2:
        return 0, 0.0
    g, h = np.cumsum(grad), np.cumsum(weight)
    gain = g[:-1] ** 2 / (h[:-1] + SHRINK) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + SHRINK)
    best = int(gain.argmax())
    return best + 1, float(gain[best] - g[-1] ** 2 / (h[-1] + SHRINK))


def _tree(grad: np.ndarray, weight: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values per bin of a tree of the given depth over one feature's bins."""
    at, gain = _cut(grad, weight) if depth else (0, 0.0)
    if not at or gain <= 1e-9:
        return np.full(len(grad), grad.sum() / (weight.sum() + SHRINK))
    return np.concatenate([_tree(grad[:at], weight[:at], depth - 1),
                           _tree(grad[at:], weight[at:], depth - 1)])


def _pair_tree(grad: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Values per cell of the best two-level tree, cutting one feature and then the other."""
    best, gain = None, -1.0
    for turned in (False, True):
        g, h = (grad.T, weight.T) if turned else (grad, weight)
        for at in range(1, len(g)):
            value, total = np.empty(g.shape), 0.0
            for rows in (slice(0, at), slice(at, None)):
                gs, hs = g[rows].sum(axis=0), h[rows].sum(axis=0)
                value[rows] = _tree(gs, hs, 1)
                total += float((gs * value[rows][0]).sum())
            if total > gain:
                best, gain = value.T if turned else value, total
    return best if best is not None else np.zeros(grad.shape), gain


def fit(table: np.ndarray, labels: np.ndarray) -> Model:
    """Boost the tables on rows of features and 0/1 labels; no label of one kind: a constant."""
    model = Model([_edges(c, BINS) for c in table.T], [_edges(c, PAIR_BINS) for c in table.T], [])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    n, pos = len(labels), labels.sum()
    model.bias = float(np.log((pos + 0.5) / (n - pos + 0.5)))
    if pos in (0, n):
        return model
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, table.T)]
    coarse = [np.searchsorted(e, c, side="right") for e, c in zip(model.pair_edges, table.T)]
    raw = np.full(n, model.bias)

    def missed():
        p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for t, b in zip(model.tables, bins):
            grad, weight = missed()
            step = RATE * _tree(np.bincount(b, grad, len(t)), np.bincount(b, weight, len(t)))
            t += step
            raw += step[b]
    cells = {}
    grad, weight = missed()
    for i in range(len(bins)):
        for j in range(i + 1, len(bins)):
            shape = len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1
            cell = coarse[i] * shape[1] + coarse[j]
            grids = [np.bincount(cell, x, shape[0] * shape[1]).reshape(shape) for x in (grad, weight)]
            cells[i, j] = _pair_tree(*grids)[1], cell, shape
    chosen = sorted(cells, key=lambda k: (-cells[k][0], k))[:PAIRS]
    grids = {k: np.zeros(cells[k][2]) for k in chosen}
    for _ in range(PAIR_ROUNDS):
        for k in chosen:
            _, cell, shape = cells[k]
            grad, weight = missed()
            value, _ = _pair_tree(*(np.bincount(cell, x, shape[0] * shape[1]).reshape(shape)
                                    for x in (grad, weight)))
            grids[k] += RATE * value
            raw += RATE * value.ravel()[cell]
    model.pairs = [(i, j, grids[i, j]) for i, j in chosen]
    return model


def learn(described: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most ``SAMPLE`` labelled documents that are not held out; their features,
    sixteen numbers each, are what reaches the driver."""
    sample = stage(label_sample(labels, "quality", SAMPLE), "labelled")
    # bounded: SAMPLE ids and labels; of several rows of one id the least features count
    rows = described.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(
        F.min(F.struct(*FEATURES)).alias("own")).select("doc_id", "label", "own.*").orderBy("doc_id").toArrow()
    table = np.column_stack([rows.column(f).to_numpy() for f in FEATURES]).astype(float)
    return fit(table, rows.column("label").to_numpy().astype(float))


def score(described: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` of every row of features."""
    shared = described.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batches):
        for b in batches:
            table = np.column_stack([b.column(f).to_numpy() for f in FEATURES]).astype(float)
            p = shared.value.score(table)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "score", "predicted"])
    return described.mapInArrow(run, "doc_id long, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from ``labels.quality`` and score all of ``docs``: ``doc_id, score, predicted``.

    Texts are read once, for their features. Null and empty texts have features zero.
    """
    described = stage(features(docs), "features")
    return score(described, learn(described, labels))
