"""Periodic runs of words, found in tiles per period octave and stitched together.

An octave holds the periods from P to 2P-1, P a power of two. A run of at least four periods
p >= P covers two neighbouring boundaries c, multiples of P, so that the P words at c and at
c+P equal those p further on. Windows of P words are told by a hash that doubles from octave
to octave; the boundaries where this may hold, with the words around them, make the tiles.
A tile is solved by itself: Z-functions at each boundary give, for all periods of the octave
at once, how far words p apart stay equal to the right and to the left. Tiles overlap, so that
the pieces of one run meet; they are brought together by document and period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import doc_texts, text_slices
from sluice.session import stage

MIN_WORDS = 6
MIN_PERIODS = 4
TILE_WORDS = 4096
CUT_BYTES = 1_000_000  # texts are split into words in cuts of about this size
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

PLAIN, PERIODIC, TILE = "plain", "periodic", "tile"
_SURVEY = [("kind", pa.string()), ("doc_id", pa.int64()), ("digest", pa.binary()), ("text", pa.string()),
           ("collapsed", pa.string()), ("period", pa.int64()), ("start", pa.int64()),
           ("anchors", pa.list_(pa.int32())), ("ids", pa.binary())]
SURVEY_TYPE = ("kind string, doc_id long, digest binary, text string, collapsed string, period long, "
               "start long, anchors array<int>, ids binary")
RESULT_TYPE = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
               "runs_sha256 string, collapsed_sha256 string")
NO_RUNS = hashlib.sha256().hexdigest()
_ASCII_BLANK = b" \t\n\v\f\r"


def cuts(data: bytes) -> Iterator[list[bytes]]:
    """Words between blanks and the controls 0x09 to 0x0D, some at a time."""
    start = 0
    while start < len(data):
        end = min(start + CUT_BYTES, len(data))
        while end < len(data) and data[end] not in _ASCII_BLANK:
            end += 1
        yield data[start:end].split()
        start = end


def periodic_from(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Place and period from which a document's words repeat themselves, if they do."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def rewritten(doc_id: int | None, words: np.ndarray) -> np.ndarray:
    """Word numbers after the repetition that ``periodic_from`` names."""
    found = periodic_from(doc_id, len(words))
    if found is None:
        return words
    a, p = found
    return np.concatenate([words[:a], words[a + np.arange(len(words) - a) % p]])


class Words:
    """Numbers of words within one slice of texts."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.words: list[bytes] = []

    def numbers(self, data: bytes) -> np.ndarray:
        parts = [np.zeros(0, np.int32)]
        for words in cuts(data):
            part = np.empty(len(words), np.int32)
            for i, w in enumerate(words):
                k = self.number.get(w)
                if k is None:
                    k = self.number[w] = len(self.words)
                    self.words.append(w)
                part[i] = k
            parts.append(part)
        return np.concatenate(parts)

    def joined_sha256(self, numbers: np.ndarray) -> str:
        made = hashlib.sha256()
        for at in range(0, len(numbers), 100_000):
            part = b" ".join(map(self.words.__getitem__, numbers[at:at + 100_000].tolist()))
            made.update(b" " + part if at else part)
        return made.hexdigest()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def boundaries(numbers: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Per octave P the boundaries at which a run of its periods may lie.

    ``numbers`` are the words of several texts, each followed by a number of its own;
    ``ends`` are the places of those. Equal hashes may be chance; the tiles decide.
    """
    longest = int(np.diff(ends, prepend=-1).max()) - 1 if len(ends) else 0
    with np.errstate(over="ignore"):
        h = _mix((numbers.astype(np.int64).view(np.uint64) + np.uint64(1)) * MULTIPLIER)
        p = 1
        while MIN_PERIODS * p <= longest:
            rows = -(-len(h) // p)
            grid = np.zeros(rows * p, np.uint64)
            grid[:len(h)] = h
            grid = grid.reshape(rows, p)
            same = grid[1:] == grid[:-1, :1]
            both = same[:-1] & same[1:]
            hit = np.nonzero(both.any(axis=1))[0]
            if len(hit):
                # The smallest period that fits must end before the text does.
                at = hit * p
                end = ends[np.searchsorted(ends, at)]
                hit = hit[at + p + both[hit].argmax(axis=1) + 2 * p <= end]
            if len(hit):
                yield p, np.union1d(hit, hit + 1) * p
            h = _mix(h[:len(h) - p] * MULTIPLIER + h[p:])
            p *= 2


def tiles(numbers: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int, list, np.ndarray]]:
    """Tiles ``(text, octave, first word, boundaries within, words)`` that may hold runs."""
    starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    for p, at in boundaries(numbers, ends):
        doc = np.searchsorted(ends, at)
        part = (at - starts[doc]) // max(TILE_WORDS, p)
        cut = np.nonzero(np.r_[True, (np.diff(doc) != 0) | (np.diff(part) != 0)])[0]
        for i, j in zip(cut, np.r_[cut[1:], len(at)]):
            d = int(doc[i])
            lo = max(int(at[i]) - p, int(starts[d]))
            hi = min(int(at[j - 1]) + 4 * p, int(ends[d]))
            yield d, p, lo - int(starts[d]), (at[i:j] - lo).tolist(), numbers[lo:hi]


def packed(words: np.ndarray) -> bytes:
    """Words numbered anew within a tile, in as few bytes each as these numbers need."""
    names, own = np.unique(words, return_inverse=True)
    width = next(w for w in (1, 2, 4) if len(names) <= 1 << 8 * w)
    return bytes([width]) + own.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> list[int]:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).tolist()


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without a tile are done; of the others the text and its tiles."""
    schema = pa.schema(_SURVEY)
    for b in batches:
        for part, texts in text_slices(b):
            known, numbers, ends, ids = Words(), [], [], part.column("doc_id").to_pylist()
            size = 0
            for i, text in enumerate(texts):
                own = rewritten(ids[i], known.numbers(text.encode("utf-8", "surrogatepass")))
                numbers += [own, np.array([-1 - i], np.int32)]
                size += len(own) + 1
                ends.append(size - 1)
            digests: dict[int, bytes] = {}
            rows: list[dict] = []
            held = 0
            for d, p, start, anchors, words in tiles(np.concatenate(numbers), np.array(ends, np.int64)):
                if d not in digests:
                    digests[d] = hashlib.sha256(texts[d].encode("utf-8", "surrogatepass")).digest()[:16]
                rows.append({"kind": TILE, "doc_id": ids[d], "digest": digests[d], "period": p,
                             "start": start, "anchors": anchors, "ids": packed(words)})
                held += len(words)
                if held > 500_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
            for i, text in enumerate(texts):
                if i in digests:
                    rows.append({"kind": PERIODIC, "doc_id": ids[i], "digest": digests[i], "text": text})
                else:
                    rows.append({"kind": PLAIN, "doc_id": ids[i],
                                 "collapsed": known.joined_sha256(numbers[2 * i])})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def z_function(s: list[int], upto: int) -> list[int]:
    """For each place below ``upto`` how long the words from there equal those of the start."""
    n = len(s)
    z = [0] * min(upto, n)
    left = right = 0
    for i in range(1, len(z)):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def equal_stretches(words: list[int], c: int, p: int) -> Iterator[tuple[int, int, int]]:
    """Per period q of the octave ``p`` the places around ``c`` whose words recur q further on.

    Yields ``(q, start, end)`` where the P words at ``c`` all recur. Periods that are
    multiples of a smaller one below P are left to that one's octave: if q + P words have
    it, so has the whole run.
    """
    last = min(2 * p - 1, len(words) - c - p)
    if last < p:
        return
    right = z_function(words[c:c + 4 * p], last + 1)
    below = max((q + right[q] for q in range(1, p)), default=0)
    found = [q for q in range(p, last + 1) if right[q] >= p and q + p > below]
    if not found:
        return
    lo = max(0, c - p)
    before = words[lo:c][::-1]
    left = z_function([*before, -1, *words[lo:c + last][::-1]], len(before) + 1 + last - p + 1)
    for q in found:
        back = left[len(before) + 1 + last - q] if before else 0
        yield q, c - back, c + right[q]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments of each tile, those of one period joined where they touch."""
    for b in batches:
        out: tuple = ([], [], [], [], [])
        for i in range(b.num_rows):
            words = unpacked(b.column("ids")[i].as_py())
            p, base = b.column("period")[i].as_py(), b.column("start")[i].as_py()
            ends: dict[int, list] = {}
            for c in b.column("anchors")[i].as_py():
                for q, s, e in equal_stretches(words, c, p):
                    held = ends.setdefault(q, [])
                    if held and s <= held[-1][1]:
                        held[-1][1] = max(e, held[-1][1])
                    else:
                        held.append([s, e])
            doc_id, digest = b.column("doc_id")[i].as_py(), b.column("digest")[i].as_py()
            for q, pieces in ends.items():
                for s, e in pieces:
                    for column, value in zip(out, (doc_id, digest, q, base + s, base + e)):
                        column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()),
             *(pa.array(c, pa.int64()) for c in out[2:])], names=["doc_id", "digest", "period", "s", "e"])


def stitched(fragments: DataFrame) -> DataFrame:
    """Runs ``doc_id, digest, start, length, period`` from the fragments of all tiles."""
    key = ["doc_id", "digest", "period"]
    own = Window.partitionBy(*key).orderBy("s", "e")
    before = F.max("e").over(own.rowsBetween(Window.unboundedPreceding, -1))
    marked = fragments.distinct().withColumn(
        "_new", F.when(F.col("s") <= before, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(own))
    runs = marked.groupBy(*key, "_run").agg(F.min("s").alias("start"), F.max("e").alias("e"))
    length = F.col("e") - F.col("start") + F.col("period")
    return runs.select("doc_id", "digest", "start", length.alias("length"), "period").where(
        F.col("length") >= F.greatest(F.lit(MIN_WORDS), MIN_PERIODS * F.col("period")))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text with its runs: their number, the longest one, both digests."""
    for b in batches:
        out: list[list] = [[] for _ in range(7)]
        for i in range(b.num_rows):
            known = Words()
            doc_id = b.column("doc_id")[i].as_py()
            words = rewritten(doc_id, known.numbers(b.column("text")[i].as_py().encode("utf-8", "surrogatepass")))
            runs = sorted((r["start"], r["period"], r["length"]) for r in b.column("runs")[i].as_py() or ())
            edge = np.zeros(len(words) + 1, np.int64)
            lines = hashlib.sha256()
            for start, period, length in runs:
                edge[start + period] += 1
                edge[start + length] -= 1
                lines.update(f"{start},{length},{period}\n".encode())
            kept = words[np.cumsum(edge[:-1]) == 0]
            best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
            row = [len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else [None] * 4),
                   lines.hexdigest(), known.joined_sha256(kept)]
            for column, value in zip(out, row):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in out[:5]),
             *(pa.array(c, pa.string()) for c in out[5:]), b.column("copies")],
            names=[f.split()[0] for f in RESULT_TYPE.split(", ")] + ["copies"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of every document: the columns of ``RESULT_TYPE``, one row per row of ``docs``.

    A run is a stretch of at least six words and four of its smallest period that no
    neighbouring word extends; words after a run's first period are collapsed. Documents
    whose id says so (``periodic_from``) are made periodic first; a null id never is. Null
    and empty texts have no words and no runs. Of several longest runs the first counts,
    then that of smaller period. Rows alike in id and text are solved together and each get
    their row. Further columns are ignored.
    """
    found = stage(doc_texts(docs).mapInArrow(_survey, SURVEY_TYPE), "survey", by=["kind"])
    plain = found.where(F.col("kind") == PLAIN).select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"),
        *[F.lit(None).cast("long").alias(c) for c in ("start", "length", "period", "exponent_milli")],
        F.lit(NO_RUNS).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"))
    fragments = found.where(F.col("kind") == TILE).select(
        "doc_id", "digest", "period", "start", "anchors", "ids").repartition(
        "doc_id", "digest", "period", "start").mapInArrow(
        _solve, "doc_id long, digest binary, period long, s long, e long")
    runs = stitched(stage(fragments, "fragments")).select(
        "doc_id", "digest", F.struct("start", "period", "length").alias("run"), F.lit(None).cast("string").alias("text"))
    texts = found.where(F.col("kind") == PERIODIC).select(
        "doc_id", "digest", F.lit(None).cast(runs.schema["run"].dataType).alias("run"), "text")
    # Texts meet their runs in one shuffle.
    whole = texts.unionByName(runs).groupBy("doc_id", "digest").agg(
        F.first("text", ignorenulls=True).alias("text"), F.count("text").alias("copies"),
        F.collect_list("run").alias("runs"))
    solved = whole.mapInArrow(_collapse, f"{RESULT_TYPE}, copies long")
    each = solved.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "_copy")
    return plain.unionByName(each)
