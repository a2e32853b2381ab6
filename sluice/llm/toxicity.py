"""Toxicity by a logistic model on words that must not lean on who is spoken of.

In sentences of labelled documents that name a group, the name is swapped for the others
of its kind. The model pays for every change of score such a swap makes, so the names of
groups end up weighing alike and neutral mentions stop raising the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import doc_texts, label_sample, text_slices
from sluice.session import stage

SAMPLE = 20_000  # labelled documents learned from at most
VOCABULARY = 4_096  # words with a weight at most
MIN_DOCS = 5  # labelled documents a word must occur in
MIN_EVIDENCE = 30.0  # chi-square with the label, enough to stand out among a million words
RIDGE = 1.0
SWAP_PENALTY = 10.0
STEPS = 300
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")
# fixed values: terms of one kind each, any of which may stand for another
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("frauen", "männer"),
    ("femmes", "hommes"), ("mujeres", "hombres"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christen", "muslime", "juden"), ("chrétiens", "musulmans", "juifs"),
    ("cristianos", "musulmanes", "judíos"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "transgender"),
    ("immigrants", "natives", "refugees", "foreigners"), ("disabled", "deaf", "blind"),
)


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def swaps(text: str) -> list[tuple[str, str]]:
    """Pairs (term, other term) for each sentence that holds a term and not the other."""
    out = []
    for sentence in SENTENCE.split(text.lower()):
        here = words_of(sentence)
        for kind in IDENTITY_TERMS:
            out += [(a, b) for a in kind if a in here for b in kind if b not in here]
    return out


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words and identity swaps of labelled documents."""
    for batch in batches:
        for part, texts in text_slices(batch):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"),
                 pa.array([sorted(words_of(t)) for t in texts], pa.list_(pa.string())),
                 pa.array([[f"{a} {b}" for a, b in swaps(t)] for t in texts], pa.list_(pa.string()))],
                names=["doc_id", "label", "words", "swaps"])


def fit(rows: list[list[int]], labels: np.ndarray, pairs: list[tuple[int, int, int]],
        size: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model with ridge and swap penalties.

    ``rows`` list the words present; ``pairs`` are (word, other word, times). Accelerated
    gradient descent on the whole sample, the step from the curvature's bound.
    """
    at = np.array([w for r in rows for w in r], dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    a, b, times = (np.array(x, dtype=np.int64) for x in (zip(*pairs) if pairs else ((), (), ())))
    swap_reach = np.bincount(np.r_[a, b], weights=np.r_[times, times] * 4.0 * SWAP_PENALTY, minlength=size)
    step = 1.0 / (_curvature(at, row, len(rows), size) + RIDGE + swap_reach)
    rate = labels.mean() if len(labels) else 0.5
    bias = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    w, old, t = np.zeros(size), np.zeros(size), 1.0
    bias_step = 4.0 / max(1, len(rows))
    for _ in range(STEPS):
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = w + (t - 1) / t_next * (w - old)
        z = bias + np.bincount(row, weights=y[at], minlength=len(rows))
        miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels
        grad = np.bincount(at, weights=miss[row], minlength=size) + RIDGE * y
        gap = 2 * SWAP_PENALTY * times * (y[a] - y[b])
        grad += np.bincount(a, weights=gap, minlength=size) - np.bincount(b, weights=gap, minlength=size)
        old, w, t = w, y - step * grad, t_next
        bias -= 0.5 * bias_step * miss.sum()
    return w, bias


def _curvature(at: np.ndarray, row: np.ndarray, rows: int, size: int) -> np.ndarray:
    """Bound on each weight's curvature: a quarter of its rows, times the words in them."""
    length = np.bincount(row, minlength=rows)
    return 0.25 * np.bincount(at, weights=length[row], minlength=size)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit the model on at most ``SAMPLE`` labelled documents that are not held out.

    Words are those of at least ``MIN_DOCS`` of these documents that set the labels
    furthest apart, beyond chance, and all identity terms. What reaches the driver is the sample's
    word numbers, at most ``SAMPLE`` times the words kept.
    """
    sample = stage(label_sample(labels, "toxic", SAMPLE), "labelled")
    own = doc_texts(docs)
    # bounded: SAMPLE ids and labels; of several texts of one id that of least hash counts
    texts = own.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    facts = texts.mapInArrow(
        _facts, "doc_id long, label int, words array<string>, swaps array<string>")
    facts = stage(facts, "facts")
    total = facts.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).first()
    n, pos = total["n"], total["pos"] or 0
    if not n or pos in (0, n):
        return Model({}, float(np.log((pos + 0.5) / (n - pos + 0.5))))
    expected = F.col("docs") * F.lit(pos / n)
    score = (F.col("hits") - expected) ** 2 / (expected * (1 - F.col("docs") / F.lit(n + 1)))
    counted = facts.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("label").alias("hits"))
    terms = [t for kind in IDENTITY_TERMS for t in kind]
    words = [r["word"] for r in counted.where(
        (F.col("docs") >= MIN_DOCS) & (score >= MIN_EVIDENCE)).orderBy(F.desc(score), "word").limit(VOCABULARY).collect()]
    place = {w: i for i, w in enumerate(dict.fromkeys([*words, *terms]))}
    known = docs.sparkSession.sparkContext.broadcast(place)  # bounded by VOCABULARY

    def numbered(batches):
        place = known.value
        for b in batches:
            kept = [[place[w] for w in ws if w in place] for ws in b.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(kept, pa.list_(pa.int32()))],
                                             names=["label", "words"])
    rows = facts.select("label", "words").mapInArrow(numbered, "label int, words array<int>").toArrow()
    swapped = facts.select(F.explode("swaps").alias("swap")).groupBy("swap").count().collect()
    pairs = [(*(place[x] for x in r["swap"].split()), r["count"]) for r in swapped]
    weights, bias = fit(rows.column("words").to_pylist(), rows.column("label").to_numpy(), pairs, len(place))
    return Model({w: float(weights[i]) for w, i in place.items() if weights[i]}, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` of every row; null and empty texts score by the bias."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by VOCABULARY

    def run(batches):
        model = shared.value
        weights, known = model.weights, model.weights.keys()
        for batch in batches:
            for part, texts in text_slices(batch):
                z = [model.bias + sum(map(weights.__getitem__, sorted(words_of(t) & known))) for t in texts]
                p = 1 / (1 + np.exp(-np.clip(np.array(z, dtype=float), -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])
    return doc_texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from ``labels.toxic`` and score all of ``docs``: ``doc_id, score, predicted``."""
    return score(docs, learn(docs, labels))
