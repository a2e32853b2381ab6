"""Languages of a document as a mixture, found by expectation-maximisation.

Every language has a model of hashed byte trigrams. A text is cut into units of 32
trigrams; each unit has a likelihood under each language. The document's proportions are
those that maximise the likelihood of its units, and its set of languages grows from the
best single one only while a further language gains more than its penalty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import doc_texts, held_out, packed_rows, text_slices
from sluice.session import stage

BUCKETS = 1 << 15
UNIT = 32  # trigrams
SAMPLE_PER_LANG = 2_000  # documents a language is learned from, about
MAX_LANGS = 200  # most frequent languages learned
ROUNDS = 15
PENALTY = 4.0  # a further language costs this many times half the logarithm of the units
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


def has_letter(text: str) -> bool:
    """Figures such as ² or ½, which the pattern takes as well, are no letters."""
    return any(m.group().isalpha() for m in LETTER.finditer(text))



def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of lower-cased texts, and how many each text has.

    A trigram counts if its middle byte belongs to a letter of any script.
    """
    data = [b" " + t.lower().encode("utf-8", "surrogatepass") + b"  " for t in texts]
    a = np.frombuffer(b"".join(data), dtype=np.uint8)
    ends = np.cumsum([len(d) for d in data])
    a, b, c = a[:-2], a[1:-1], a[2:]
    use = (b >= 0x80) | ((b >= 97) & (b <= 122))
    at = np.nonzero(use)[0]
    code = (a[at].astype(np.uint32) << 16 | b[at].astype(np.uint32) << 8 | c[at]) * np.uint32(0x9E3779B1)
    return (code >> np.uint32(17)).astype(np.int32), np.diff(np.searchsorted(at, np.r_[0, ends]))


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    log_probs: np.ndarray  # (languages, buckets)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language over a task's documents."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for part, texts in text_slices(batch):
            grams, sizes = trigrams([t or "" for t in texts])
            lo = 0
            for lang, n in zip(part.column("lang").to_pylist(), sizes.tolist()):
                table = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                table += np.bincount(grams[lo:lo + n], minlength=BUCKETS)
                lo += n
    for lang, table in sums.items():
        at = np.nonzero(table)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(table[at])],
            names=["lang", "bucket", "n"])


def learn(docs: DataFrame) -> Model:
    """Trigram models from a bounded sample: for each of the ``MAX_LANGS`` most frequent
    values of ``lang`` about ``SAMPLE_PER_LANG`` learnable documents, those whose id hash
    falls in the share of the language's documents that this number is.

    No language's documents meet in one task, however many they are. What reaches the
    driver is the model itself: languages times buckets numbers.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select(
        F.xxhash64(F.col("doc_id").cast("long")).alias("h"), "lang", F.coalesce("text", F.lit("")).alias("text"))
    langs = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).select(
        "lang", (F.lit(SAMPLE_PER_LANG) / F.col("count")).alias("share"))
    # bounded: MAX_LANGS rows
    texts = usable.join(F.broadcast(langs), "lang").where(
        F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30)).select("lang", "text")
    sums = texts.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toArrow()
    lang = sums.column("lang").to_pylist()
    names = sorted(set(lang))
    table = np.full((len(names), BUCKETS), 0.1)
    place = {n: i for i, n in enumerate(names)}
    np.add.at(table, ([place[x] for x in lang], sums.column("bucket").to_numpy()), sums.column("n").to_numpy())
    logs = np.log(table / table.sum(axis=1, keepdims=True)) if names else table
    return Model(tuple(names), logs.astype(np.float32))


def unit_likelihoods(model: Model, grams: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of each unit under each language, and the number of units per text."""
    units = -(-sizes // UNIT)
    first = np.cumsum(sizes) - sizes
    start = np.repeat(first, units) + UNIT * (np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units))
    out = np.empty((len(start), len(model.langs)))
    for k, row in enumerate(model.log_probs):
        out[:, k] = np.add.reduceat(row[grams], start) if len(start) else 0
    return out, units


def mixture(logs: np.ndarray, text: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood per text by expectation-maximisation.

    ``logs`` are (units, languages), ``text`` the text each unit belongs to, ascending
    without gaps, ``allowed`` the (texts, languages) a text may use.
    """
    top = logs.max(axis=1, keepdims=True)
    like = np.exp(logs - top)
    start = np.r_[0, np.nonzero(np.diff(text))[0] + 1]
    count = np.diff(np.r_[start, len(text)])[:, None]
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        part = like * share[text]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
        share = np.add.reduceat(part, start) / count
    total = np.log(np.maximum((like * share[text]).sum(axis=1), 1e-300)) + top[:, 0]
    return share, np.add.reduceat(total, start)


def infer(model: Model, texts: list[str]) -> np.ndarray:
    """Proportions of the languages chosen for each text; zeros for a text without units."""
    grams, sizes = trigrams(texts)
    logs, units = unit_likelihoods(model, grams, sizes)
    shares = np.zeros((len(texts), len(model.langs)))
    rows = np.nonzero(units)[0]
    if not len(rows) or not model.langs:
        return shares
    start = (np.cumsum(units) - units)[rows]
    single = np.add.reduceat(logs, start)
    chosen = np.zeros_like(single, dtype=bool)
    chosen[np.arange(len(rows)), single.argmax(axis=1)] = True
    shares[rows] = chosen
    reached = single.max(axis=1)
    cost = PENALTY * 0.5 * np.log(units[rows] + 1)
    # no mixture does better than the best language of each unit
    bound = np.add.reduceat(logs.max(axis=1), start)
    open_ = np.nonzero(bound - reached > cost)[0]
    while len(open_):
        text = np.repeat(np.arange(len(open_)), units[rows[open_]])
        unit = np.concatenate([np.arange(start[i], start[i] + units[rows[i]]) for i in open_])
        best = np.full(len(open_), -np.inf)
        best_share, best_lang = np.zeros((len(open_), len(model.langs))), np.zeros(len(open_), dtype=int)
        for k in range(len(model.langs)):
            allowed = chosen[open_].copy()
            fresh = ~allowed[:, k]
            allowed[:, k] = True
            share, value = mixture(logs[unit], text, allowed)
            better = fresh & (value > best)
            best[better], best_lang[better], best_share[better] = value[better], k, share[better]
        gain = best - reached[open_] > cost[open_]
        took = open_[gain]
        chosen[took, best_lang[gain]] = True
        shares[rows[took]], reached[took] = best_share[gain], best[gain]
        open_ = took[~chosen[took].all(axis=1)]
    return shares


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, mixture`` for every row of ``docs``.

    ``score`` is the proportion of the largest language, ``mixture`` a map of all chosen.
    Null texts and texts without a letter give ``und``, score 0 and an empty map, as does
    every text if there was no language to learn.
    """
    return _predict(docs, model).drop("_th")


def _predict(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``predict`` and ``_th``, a hash that tells texts of one id apart."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages times buckets

    def run(batches):
        model = shared.value
        for batch in batches:
            for part, texts in text_slices(batch):
                known = [has_letter(t) for t in texts]
                shares = infer(model, [t if k else "" for t, k in zip(texts, known)])
                lang, score, mixed = [], [], []
                for row in shares:
                    top = int(row.argmax()) if len(row) and row.any() else None
                    lang.append(UNKNOWN if top is None else model.langs[top])
                    score.append(0.0 if top is None else min(1.0, float(row[top])))
                    mixed.append([(model.langs[k], float(row[k])) for k in np.nonzero(row)[0]])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array(mixed, pa.map_(pa.string(), pa.float64())), part.column("_th")],
                    names=["doc_id", "lang_pred", "score", "mixture", "_th"])

    return doc_texts(docs).withColumn("_th", F.xxhash64("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, mixture map<string,double>, _th long")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from ``docs`` and predict all of them: the columns of ``predict``."""
    return predict(docs, learn(docs))


def keep_known(docs: DataFrame) -> DataFrame:
    """``docs`` without texts in no known language (``und``); all columns stay.

    Of rows that share an id, or have none, only those with such a text go.
    """
    found = _predict(docs, learn(docs)).where(F.col("lang_pred") == UNKNOWN).select(
        F.col("doc_id").alias("_bad_id"), F.col("_th").alias("_bad_th")).distinct()
    unknown = stage(found, "unknown").hint("merge")
    return packed_rows(docs).join(unknown, F.col("_id").eqNullSafe(F.col("_bad_id")) & (
        F.col("_th") == F.col("_bad_th")), "left_anti").select("_row.*")
