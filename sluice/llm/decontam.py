r"""Benchmark decontamination by templates.

A text becomes a row of tokens: runs of digits are a ``number`` slot, a unit right after
a number is a ``unit`` slot, a run of capitalised words is one ``name`` slot, all other words
stand for themselves in lower case; scripts without blanks are cut by character. Windows of
eight tokens are hashed with the slot kinds in place of their values, so a question asked
again with other figures or names meets its template. Windows of an item and a document
that line up are gathered per shift and judged together: of the slots the largest part that
maps each value of the item to one value counts, and the plain words met must be enough, or
the whole item met. Every window is also hashed with its values, over single words, which
finds copies whose capitals changed; a window of the same words always counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import doc_texts, packed_rows, text_slices
from sluice.session import stage

WINDOW = 8
MIN_TOKENS = 5  # shorter items are only matched word for word
MIN_PLAIN = 5  # plain words the templates of a shift must meet
MIN_PLAIN_WHOLE = 2  # if they meet the whole item
COVERAGE = 0.5  # share of an item's tokens that must be met
BROADCAST_WINDOWS = 2_000_000  # 8 bytes each; beyond, windows are joined by a shuffle
# fixed values: Thai, Lao, Tibetan, Myanmar, Khmer, kana, ideographs
NO_BLANKS = ("\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf"
             "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")
TOKEN = re.compile(rf"\d+(?:[.,]\d+)*|(?=[{NO_BLANKS}])[^\W\d_]|[^\W\d_{NO_BLANKS}]+")
# fixed values: units of measure, in lower case
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms "
    "ton tons tonne tonnes oz ounce ounces lb lbs pound pounds ml l liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks "
    "month months year years km2 m2 acre acres hectare hectares percent dollar dollars euro euros "
    "cent cents usd eur degree degrees kmh mph w kw kwh v volt volts watt watts hz mb gb tb "
    "meter meters metre metres kilometer kilometers kilometre kilometres".split())
PLAIN, NUMBER, NAME, UNIT = range(4)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MEMO_TOKENS = 200_000


class Tokens(dict):
    """By token its value's hash, its kind (bits 0-1) and whether it is a unit (bit 2).

    Lives for one task and forgets all when full.
    """

    def __missing__(self, token: str) -> int:
        if len(self) >= MEMO_TOKENS:
            self.clear()
        low = token.lower()
        kind = NUMBER if token[0].isdecimal() else NAME if token[0] != low[0] else PLAIN
        value = xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass")) & ~7
        made = self[token] = value | kind | (4 if low in UNITS else 0)
        return made


def _codes(tokens: list[str], memo: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Per token a hash of its value and its kind."""
    raw = np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))
    kind = (raw & np.uint64(3)).astype(np.int8)
    unit = (raw & np.uint64(4)) > 0
    unit[1:] &= kind[:-1] == NUMBER
    unit[:1] = False
    kind[unit] = UNIT
    return raw & ~np.uint64(7), kind


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def window_hashes(marks: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Per window of ``n`` tokens its hash."""
    count = max(0, len(marks) - n + 1)
    out = np.full(count, n + seed, np.uint64)
    for k in range(n if count else 0):
        out = out * MULTIPLIER + marks[k:k + count]
    return _mix(out).view(np.int64)


class _Texts:
    """Tokens of several texts in a row, each text a stretch of its own.

    ``rows`` has by ``same`` two rows of them: all tokens by value, and by shape with a run
    of names as one. A row is its marks, the ends of the texts in it, and the first token of each
    of its places, with one more at the end.
    """

    def __init__(self, texts: list[str | None], memo: Tokens):
        found = [TOKEN.findall(t or "") for t in texts]
        self.sizes = np.array([len(t) for t in found], dtype=np.int64)
        ends = np.cumsum(self.sizes)
        self.tokens = [t for tokens in found for t in tokens]
        starts = (ends - self.sizes)[self.sizes > 0]
        value, kind = self.value, self.kind = _codes(self.tokens, memo)
        kind[starts[kind[starts] == UNIT]] = PLAIN  # after a number of the text before
        name = kind == NAME
        goes_on = np.zeros(len(name), dtype=bool)
        goes_on[1:] = name[1:] & name[:-1]
        goes_on[starts] = False
        first = np.nonzero(~goes_on)[0]
        shape = _mix(np.where(kind == PLAIN, value, kind.astype(np.uint64)))[first]
        total = [len(self.tokens)]
        self.rows = {True: (_mix(value), ends, np.arange(total[0] + 1)),
                     False: (shape, np.searchsorted(first, ends), np.r_[first, total].astype(np.int64))}
        self.slotted = np.cumsum(np.r_[0, kind[first] != PLAIN])

    def hashes(self, n: int, same: bool) -> np.ndarray:
        return window_hashes(self.rows[same][0], n, 64 if same else 0)

    def has_slot(self, at: np.ndarray, n: int) -> np.ndarray:
        """Whether the template windows at these places have a slot."""
        return self.slotted[at + n] > self.slotted[at]

    def slots(self, at: int, n: int) -> list[str]:
        """``kind:value`` per place of a template window, empty for plain words."""
        place = self.rows[False][2]
        return [f"{self.kind[a]}:{' '.join(self.tokens[a:b])}" if self.kind[a] else ""
                for a, b in zip(place[at:at + n].tolist(), place[at + 1:at + n + 1].tolist())]


# ``starts`` has the first token of each place of an item's window, and one more at the end
WINDOW_SCHEMA = "id long, n_tokens int, at int, n int, hash long, same boolean, slots array<string>, starts array<int>"
WINDOW_TYPES = pa.schema([("id", pa.int64()), ("n_tokens", pa.int32()), ("at", pa.int32()),
                          ("n", pa.int32()), ("hash", pa.int64()), ("same", pa.bool_()),
                          ("slots", pa.list_(pa.string())), ("starts", pa.list_(pa.int32()))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), WINDOW_TYPES)], schema=WINDOW_TYPES)


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of the items; an item shorter than a window is one window itself.

    Templates without slots say what the words say; those of an item of fewer than five
    places, or of hardly a plain word, say nothing.
    """
    memo = Tokens()
    for b in batches:
        for key, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist()):
            t, rows = _Texts([text], memo), []
            for same, (marks, _, place) in t.rows.items():
                size, n = len(marks), min(WINDOW, len(marks))
                if not size or not same and (
                        size < MIN_TOKENS or (t.kind == PLAIN).sum() < MIN_PLAIN_WHOLE):
                    continue
                hashes, at = t.hashes(n, same), np.arange(size - n + 1)
                for p in (at if same else at[t.has_slot(at, n)]).tolist():
                    rows.append((key, len(t.tokens), p, n, int(hashes[p]), same,
                                 [] if same else t.slots(p, n), place[p:p + n + 1].tolist()))
            if rows:
                yield _batch(rows)


def _doc_windows(lengths: list[tuple[int, bool]], wanted=None):
    """Batch function giving the windows of documents, only those of ``wanted`` hashes if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Tokens()
        mask = (1 << 22) - 1
        if wanted is not None:
            near = np.zeros(mask + 1, dtype=bool)  # most windows end here
            near[wanted.value & mask] = True
        for batch in batches:
            for part, texts in text_slices(batch):
                t, rows = _Texts(texts, memo), []
                ids = part.column("doc_id").to_pylist()
                for n, same in lengths:
                    h, ends = t.hashes(n, same), t.rows[same][1]
                    at = np.arange(len(h)) if wanted is None else np.nonzero(near[h & mask])[0]
                    if wanted is not None:
                        at = at[np.isin(h[at], wanted.value)]
                    if not same:
                        at = at[t.has_slot(at, n)]
                    i = np.searchsorted(ends, at, side="right")
                    inside = at + n <= ends[i]
                    for p, k in zip(at[inside].tolist(), i[inside].tolist()):
                        rows.append((ids[k], int(t.sizes[k]), p - int(ends[k - 1] if k else 0), n,
                                     int(h[p]), same, [] if same else t.slots(p, n), []))
                        if len(rows) == 50_000:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)
    return run


def met_tokens(n_tokens: int, windows: list[dict]) -> list[int]:
    """Tokens of an item met by the templates of one shift; none without enough evidence.

    Each value of the item goes with the document's value it meets at most places; the
    other places are not met. If these are more than half of the numbers and names,
    the values contradict the item. Two values of the item may meet the same one. Left
    must be ``MIN_PLAIN`` plain words, or ``MIN_PLAIN_WHOLE`` if the windows span the item.
    """
    pairs = {}
    for w in windows:
        for a, b, mine, theirs in zip(w["starts"], w["starts"][1:], w["slots"], w["doc_slots"]):
            pairs.setdefault((a, b, mine), set()).add(theirs)
    votes: dict[str, Counter] = {}
    for (_, _, mine), theirs in pairs.items():
        votes.setdefault(mine, Counter()).update(theirs)
    chosen = {mine: min(v, key=lambda x: (-v[x], x)) for mine, v in votes.items()}
    kept = [p for p, theirs in pairs.items() if chosen[p[2]] in theirs]
    values = [p for p in pairs if p[2] and not p[2].startswith(f"{UNIT}:")]
    held = sum(bool(p[2]) and not p[2].startswith(f"{UNIT}:") for p in kept)
    plain = sum(not p[2] for p in kept)
    whole = sum(b - a for a, b, _ in pairs) == n_tokens
    if 2 * held < len(values) or plain < (MIN_PLAIN_WHOLE if whole else MIN_PLAIN):
        return []
    return [i for a, b, _ in kept for i in range(a, b)]


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        met = [[i for w in windows for i in range(w["starts"][0], w["starts"][-1])] if same
               else met_tokens(n, windows) for n, same, windows in zip(
                   *(b.column(c).to_pylist() for c in ("n_tokens", "same", "windows")))]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("doc_id", "item_id", "n_tokens", "same")),
             pa.array([sorted(set(m)) for m in met], pa.list_(pa.int32()))],
            names=["doc_id", "item_id", "n_tokens", "same", "met"])


def contaminated(docs: DataFrame, benchmark: DataFrame,
                 broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``doc_id, item_id, coverage, exact`` for each document that holds half an item or more.

    ``coverage`` is the share of the item's tokens met by windows that line up with it;
    ``exact`` tells whether windows of the same words alone reach the threshold (case
    aside). Items of equal text count as the one of smallest ``item_id``. Items of fewer
    than five tokens are met as a whole, word for word; items without token, null texts and
    rows with null id take no part. Rows that share a ``doc_id`` are judged as one document.
    Shifts are judged one by one, tokens united.
    """
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").groupBy("text").agg(
        F.min("item_id").cast("long").alias("item_id"))
    asked = stage(items.mapInArrow(_item_windows, WINDOW_SCHEMA), "asked")
    lengths = sorted((r["n"], r["same"]) for r in asked.select("n", "same").distinct().collect())  # 16 at most
    hashes = asked.select("hash").distinct()
    wanted = None
    if hashes.count() <= broadcast_windows:
        wanted = docs.sparkSession.sparkContext.broadcast(
            np.sort(hashes.toArrow().column("hash").to_numpy()))
    texts = doc_texts(docs).where("doc_id IS NOT NULL")
    met = texts.mapInArrow(_doc_windows(lengths, wanted), WINDOW_SCHEMA).select(
        F.col("id").alias("doc_id"), F.col("at").alias("doc_at"), "hash",
        F.col("slots").alias("doc_slots"))
    # what the broadcast lets through is little: written once, joined by hash
    met = stage(met, "met") if wanted is not None else met
    asked = asked.withColumnRenamed("id", "item_id")
    shifts = met.join(asked, "hash").groupBy(
        "doc_id", "item_id", "n_tokens", "n", "same", (F.col("doc_at") - F.col("at")).alias("shift")).agg(
        F.collect_set(F.struct("starts", "slots", "doc_slots")).alias("windows"))
    judged = shifts.select("doc_id", "item_id", "n_tokens", "same", "windows").mapInArrow(
        _judge, "doc_id long, item_id long, n_tokens int, same boolean, met array<int>")

    def share(met):
        return F.size(F.array_distinct(F.flatten(F.collect_set(met)))) / F.col("n_tokens")

    return judged.groupBy("doc_id", "item_id", "n_tokens").agg(
        share(F.col("met")).alias("coverage"),
        (share(F.when(F.col("same"), F.col("met"))) >= COVERAGE).alias("exact")).where(
        F.col("coverage") >= COVERAGE).select("doc_id", "item_id", "coverage", "exact")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents; rows with null id stay."""
    found = stage(contaminated(docs, benchmark).select(F.col("doc_id").alias("_leak_id")).distinct(), "leaks")
    return packed_rows(docs).join(
        found.hint("merge"), F.col("_id") == F.col("_leak_id"), "left_anti").select("_row.*")
