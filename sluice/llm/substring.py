"""Removal of long word windows that start in an earlier document, by level-wise doubling.

A window of ``WINDOW`` words can only be repeated if shorter windows inside it are. Levels
of about half, quarter ... of that length are tested from the shortest up. At each level a
window is stood for by its minimizer, the sub-window of the level's length with the
smallest hash: equal windows have equal minimizers, so a window whose minimizer occurs in
one document alone is out, and only the others are extended to twice the length. The last
level is the window itself. Nothing shorter than a level's few minimizers is ever shuffled,
and whole windows are shuffled only where every shorter level is repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import doc_texts
from sluice.session import stage

WINDOW = 50
MULTIPLIER = 0x9E3779B97F4A7C15  # odd, for rolling sums of word hashes modulo 2**64
MEMO_WORDS = 200_000


class WordHashes(dict):
    """64-bit hash by word, for one task; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made


def words_of(text: str | None) -> list[bytes]:
    """Words between blanks and the controls 0x09 to 0x0D, unchanged."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that their order is as good as random."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` word hashes, from those of half the length."""
    if n == 1:
        return words
    half = (n + 1) // 2
    part = window_hashes(words, half)
    if len(words) < n:
        return words[:0]
    back = n - half
    return _mix(part[:len(words) - n + 1] * np.uint64(MULTIPLIER)
                + part[back:back + len(words) - n + 1])


def minimizers(hashes: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` hashes the place of its smallest, the first one among equals."""
    best = np.arange(len(hashes))
    width = 1
    while width < span:
        step = min(width, span - width)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(hashes[right] < hashes[left], right, left)
        width += step
    return best


def levels(window: int) -> list[int]:
    """Lengths from the shortest up, each at most twice the one before."""
    out = [window]
    while out[0] > 13:
        out.insert(0, (out[0] + 1) // 2)
    return out


class Windows:
    """Windows of one text: their hashes and, per level, their minimizers."""

    def __init__(self, text: str | None, memo: WordHashes, window: int):
        self.words = words_of(text)
        self.hashes = np.fromiter(map(memo.__getitem__, self.words), np.uint64, len(self.words))
        self.window = window

    def minimizers(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Per window the place and the hash of its minimizer of ``length`` words."""
        h = window_hashes(self.hashes, length)
        at = minimizers(h, self.window - length + 1)
        return at, h[at].view(np.int64)


def _survey(window: int):
    """Per text: word count, digest of its words, digest of the kept text, first level."""
    shortest = levels(window)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for b in batches:
            count, digest, marks = [], [], []
            for value in b.column("text"):
                w = Windows(value.as_py(), memo, window)
                count.append(len(w.words))
                digest.append(hashlib.sha256(b" ".join(w.words)).hexdigest())
                marks.append(np.unique(w.minimizers(shortest)[1]) if len(w.words) >= window
                             else np.zeros(0, dtype=np.int64))
            lists = pa.ListArray.from_arrays(
                np.cumsum([0, *map(len, marks)]).astype(np.int32),
                np.concatenate([*marks, np.zeros(0, dtype=np.int64)]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(count, pa.int64()),
                 pa.array(digest, pa.string()), lists], names=["doc_id", "th", "n_words", "digest", "marks"])
    return run


def _extend(window: int):
    """Windows whose first-level minimizer is shared, one row per run of equal minimizers.

    Each row carries the minimizers of the further levels and the hashes of its windows.
    """
    shortest, *between, _ = levels(window) if len(levels(window)) > 1 else [window, window]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for b in batches:
            shared = b.column("shared")
            for i, value in enumerate(b.column("text")):
                w = Windows(value.as_py(), memo, window)
                if len(w.words) < window:
                    continue
                keep = np.isin(w.minimizers(shortest)[1], shared[i].values.to_numpy())
                found = [w.minimizers(n) for n in between]
                at = np.nonzero(keep)[0]
                if not len(at):
                    continue
                cut = np.diff(at) != 1
                for place, _ in found:
                    cut |= np.diff(place[at]) != 0
                start = np.nonzero(np.r_[True, cut])[0]
                whole = window_hashes(w.hashes, window)[at].view(np.int64)
                lists = pa.ListArray.from_arrays(np.r_[start, len(at)].astype(np.int32), whole)
                marks = [pa.array(h[at][start]) for _, h in found]
                ids, ths = (pa.array([b.column(c)[i].as_py()] * len(start), pa.int64()) for c in ("doc_id", "th"))
                yield pa.RecordBatch.from_arrays(
                    [ids, ths, pa.array(at[start]), lists, *marks],
                    names=["doc_id", "th", "at", "windows", *(f"mark{n}" for n in between)])
    schema = "doc_id long, th long, at long, windows array<long>" + "".join(
        f", mark{n} long" for n in between)
    return run, schema, [f"mark{n}" for n in between]


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur in two documents at least, with the smallest of these."""
    return rows.groupBy(*keys).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("end")) \
        .where("first < end").select(*keys, "first")


def _cover(window: int):
    """Drop the covered words of a text; the places are where repeated windows start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, digest, kept_texts = [], [], []
            for value, places in zip(b.column("text"), b.column("places")):
                words = words_of(value.as_py())
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                starts = places.values.to_numpy()
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + window, -1)
                covered = np.cumsum(edge[:-1]) > 0
                kept = b" ".join(w for w, c in zip(words, covered.tolist()) if not c)
                removed.append(int(covered.sum()))
                digest.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(removed, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(kept_texts, pa.string())],
                names=["doc_id", "th", "n_removed", "kept_sha256", "kept"])
    return run


_SURVEY_TYPE = "doc_id long, th long, n_words long, digest string, marks array<long>"


def _texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and ``th``, a hash that tells texts of one id apart."""
    return doc_texts(docs).withColumn("th", F.xxhash64("text"))


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The survey of all documents, and the starts ``doc_id, th, at`` of windows to remove.

    Documents whose words are those of an earlier document count as copies: all their
    windows start in it, so they need no search and never decide about others.
    """
    texts = _texts(docs).where("doc_id IS NOT NULL")
    survey = stage(texts.mapInArrow(_survey(window), _SURVEY_TYPE), "survey")
    firsts = stage(survey.groupBy("digest").agg(F.min("doc_id").alias("first_copy")), "firsts")
    survey = stage(survey.join(firsts, "digest"), "survey")
    singles = survey.where("doc_id = first_copy").select("doc_id", F.explode("marks").alias("mark"))
    marks = stage(_shared(singles, ["mark"]).select("mark"), "marks")
    per_doc = singles.join(marks, "mark").groupBy("doc_id").agg(F.collect_set("mark").alias("shared"))
    run, schema, between = _extend(window)
    rows = texts.join(stage(per_doc, "shared"), "doc_id").mapInArrow(run, schema)
    rows = stage(rows, "windows")
    for mark in between:
        rows = stage(rows.join(stage(_shared(rows, [mark]).select(mark), mark), mark), "extended")
    each = rows.select("doc_id", "th", *between, F.posexplode("windows").alias("step", "hash"), "at").select(
        "doc_id", "th", *between, "hash", (F.col("at") + F.col("step")).alias("at"))
    shared = stage(_shared(each, [*between, "hash"]), "repeats")
    starts = each.join(shared, [*between, "hash"]).where("doc_id > first").select("doc_id", "th", "at")
    return survey, starts


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: ``doc_id, n_words, n_removed, kept_sha256, kept``.

    A word goes if it is covered by a window of ``window`` words that also starts in a
    document of smaller id; windows are judged on the input. ``kept`` is the text left,
    words joined by one blank; it is null where nothing was removed. Null texts have no
    words. Every row gets its row: those of one id are told apart by their texts, and never
    lose words to one another. A row with null id keeps all its words.
    """
    survey, starts = repeated_windows(docs, window)
    places = stage(starts.groupBy("doc_id", "th").agg(F.collect_set("at").alias("places")), "places")
    texts = _texts(docs)
    cut = stage(texts.join(places, ["doc_id", "th"]).mapInArrow(
        _cover(window), "doc_id long, th long, n_removed long, kept_sha256 string, kept string"), "cut")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    copy = (F.col("doc_id") > F.col("first_copy")) & (F.col("n_words") >= window)
    known = survey.drop("marks").join(cut.dropDuplicates(["doc_id", "th"]), ["doc_id", "th"], "left").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, nothing).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"))
    unnamed = texts.where("doc_id IS NULL").mapInArrow(_survey(window), _SURVEY_TYPE).select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"),
        F.col("digest").alias("kept_sha256"), F.lit(None).cast("string").alias("kept"))
    return known.union(unnamed)
