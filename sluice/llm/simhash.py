"""SimHash near-duplicates, found through Golay-coded segments.

A 64-bit fingerprint is cut into three segments, each seen as a word of the binary Golay
code of length 23. Every 23-bit word lies within 3 bits of exactly one codeword. Its keys
are that codeword and, if it is exactly 3 bits away, the five codewords 4 bits away; for
words nearer than that there is one key. Two facts carry the search:

* words at most 2 bits apart share a key;
* words at most 1 bit apart: the nearest codeword of either is a key of the other.

Four errors over three segments leave two segments with at most (1, 1) or (0, 2) errors.
So fingerprints within 4 bits meet under a key made of two segments: nearest codeword of
the one with any key of the other, both ways round (1, 1), or the exact bits of the one
with any key of the other (0, 2). Rows that meet are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import doc_texts, packed_rows, text_slices
from sluice.llm.components import components
from sluice.session import stage

SHINGLE_WORDS = 4
MAX_BITS = 4
GENERATOR = 0b101011100011  # fixed value: generator polynomial of the Golay code
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
SMALL_BUCKET = 256  # rows under one key compared within one stream; larger ones are split
BLOCK = 2048  # fingerprints of a large bucket compared with as many others in one task
PIECE = 200_000  # shingles hashed at a time
COPY_WORDS = 5  # words of a shingle of near_copies
SIMILARITY = 0.8  # Jaccard similarity of near copies
BANDS, BAND_ROWS = 24, 4  # a pair at 0.8 shares no band with a chance of (1 - 0.8**4)**24 = 3e-6
GROUP_MEMBERS = 4096  # members of an open bucket compared with as many others at a time
GROUP_SHINGLES = 1 << 20  # of such members, and of the small buckets one task takes together
SHARED_COLUMNS = 4096  # shingles counted at a time
FACTORS = np.random.default_rng(5).integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---- fingerprints

def fingerprint(text: str | None) -> int:
    """64-bit SimHash of lower-cased (A-Z only) words in shingles of four; no word: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, PIECE):
        part = words[lo:lo + PIECE + SHINGLE_WORDS - 1]
        joined = map(b" ".join, zip(*(part[k:] for k in range(SHINGLE_WORDS)))) \
            if len(part) >= SHINGLE_WORDS else [b" ".join(part)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in joined), dtype=np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        marks = [fingerprint(t.as_py()) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(np.array(marks, dtype=np.uint64).view(np.int64))],
            names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the fingerprint's 64 bits as a long, one row per row of ``docs``."""
    return doc_texts(docs).mapInArrow(_fingerprints, "doc_id long, fp long")


# ---- Golay keys

@cache
def _leaders() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of each 23-bit unit vector, and the least error word of each remainder."""
    rest = np.zeros(23, dtype=np.int64)
    for i in range(23):
        r = 1 << i
        for k in range(22, 10, -1):
            if r >> k & 1:
                r ^= GENERATOR << (k - 11)
        rest[i] = r
    leader = np.full(2048, -1, dtype=np.int64)
    leader[0] = 0
    for i in range(23):
        leader[rest[i]] = 1 << i
        for j in range(i):
            leader[rest[i] ^ rest[j]] = 1 << i | 1 << j
            for k in range(j):
                leader[rest[i] ^ rest[j] ^ rest[k]] = 1 << i | 1 << j | 1 << k
    return rest, leader


def nearest(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index (top 12 bits) of the codeword within 3 bits of each word, and its distance."""
    rest, leader = _leaders()
    remainder = np.zeros(words.shape, dtype=np.int64)
    for i in range(23):
        remainder ^= np.where(words >> i & 1, rest[i], 0)
    error = leader[remainder]
    return (words ^ error) >> 11, np.bitwise_count(error)


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest codeword index, and an (n, 6) table of all keys padded with the first."""
    first, distance = nearest(words)
    flipped, _ = nearest(words[:, None] ^ (1 << np.arange(23)))
    flipped = np.sort(np.where((distance == 3)[:, None], flipped, first[:, None]), axis=1)
    fresh = np.ones(flipped.shape, dtype=bool)
    fresh[:, 1:] = flipped[:, 1:] != flipped[:, :-1]
    place = np.cumsum(fresh, axis=1) - 1
    keys = np.repeat(first[:, None], 6, axis=1)
    rows = np.nonzero(fresh)[0]
    keys[rows, place[fresh]] = flipped[fresh]
    return first, keys


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Search keys of fingerprints, as (row number, 64-bit key) pairs without repeats."""
    segments = [(fps >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64)
                for at, width in SEGMENTS]
    coded = [golay_keys(s) for s in segments]
    columns = []
    for kind, (a, b) in enumerate(permutations(range(3), 2)):
        columns.append((1 << 60) + (kind << 40) + (segments[a] << 12)[:, None] + coded[b][1])
        lo, hi = min(a, b), max(a, b)
        pair = (coded[lo][0][:, None] << 12) + coded[hi][1] if a < b else \
            (coded[lo][1] << 12) + coded[hi][0][:, None]
        columns.append(((lo + hi) << 40) + pair)
    keys = np.sort(np.concatenate(columns, axis=1), axis=1)
    fresh = np.ones(keys.shape, dtype=bool)
    fresh[:, 1:] = keys[:, 1:] != keys[:, :-1]
    return np.nonzero(fresh)[0], keys[fresh]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = b.column("fp").to_numpy(zero_copy_only=False)
        for lo in range(0, len(fps), 4096):
            part = fps[lo:lo + 4096]
            row, key = bucket_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])],
                                             names=["key", "fp"])


# ---- comparing within buckets

def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node reached) that connect the same nodes as the edges given."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _close_in_runs(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of equal key, rows being sorted by key."""
    us, vs = [fp[:0]], [fp[:0]]
    at = np.arange(len(key))
    for step in range(1, len(key)):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        if not len(at):
            break
        near = at[np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64)) <= MAX_BITS]
        us.append(fp[near])
        vs.append(fp[near + step])
    return np.concatenate(us), np.concatenate(vs)


LINK = "key long, u long, v long"  # key is null in a link; a row of a large bucket has no v


def _link_batch(key, u, v) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([key, u, v], names=["key", "u", "v"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream rows sorted by key; link small buckets, pass the rows of large ones on.

    Holds one batch and at most one small bucket at a time.
    """
    def links(key, fp):
        u, v = forest(*_close_in_runs(key, fp))
        return _link_batch(pa.nulls(len(u), pa.int64()), pa.array(u), pa.array(v))

    def large(key, fp):
        return _link_batch(pa.array(key), pa.array(fp), pa.nulls(len(fp), pa.int64()))

    held_key = held_fp = np.zeros(0, dtype=np.int64)
    big = None  # key of the large bucket now passing by
    for b in batches:
        key = np.concatenate([held_key, b.column("key").to_numpy(zero_copy_only=False)])
        fp = np.concatenate([held_fp, b.column("fp").to_numpy(zero_copy_only=False)])
        if not len(key):
            continue
        start = np.nonzero(np.r_[True, key[1:] != key[:-1]])[0]
        size = np.diff(np.r_[start, len(key)])
        is_large = (size > SMALL_BUCKET) | (key[start] == big)
        big = key[-1] if is_large[-1] else None
        row_large = np.repeat(is_large, size)
        done = np.repeat(size > 1, size) & ~row_large
        tail = 0 if is_large[-1] else size[-1]  # the last bucket may go on in the next batch
        done[len(key) - tail:] = False
        if row_large.any():
            yield large(key[row_large], fp[row_large])
        if done.any():
            yield links(key[done], fp[done])
        held_key, held_fp = key[len(key) - tail:], fp[len(key) - tail:]
    if len(held_key) > 1:
        yield links(held_key, held_fp)


def close_links(fps: np.ndarray, others: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one block, or of the pairs between two blocks."""
    us, vs = [fps[:0]], [fps[:0]]
    right = fps if others is None else others
    for lo in range(0, len(fps), 256):
        left = fps[lo:lo + 256]
        near = np.bitwise_count((left[:, None] ^ right[None, :]).view(np.uint64)) <= MAX_BITS
        i, j = np.nonzero(near)
        u, v = forest(left[i], right[j])
        us.append(u)
        vs.append(v)
    return forest(np.concatenate(us), np.concatenate(vs))


def _compare_blocks(rows: pa.Table) -> pa.Table:
    fp, second = rows.column("fp").to_numpy(), rows.column("second").to_numpy()
    single = not second.any()
    u, v = close_links(fp[second == 0], None if single else fp[second == 1])
    return pa.table({"u": u, "v": v})


def _large_links(rows: DataFrame) -> DataFrame:
    """Compare the rows of large buckets block against block, each pair in its own task."""
    rows = stage(rows.distinct(), "large")
    blocks = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n"))
    dealt = rows.join(stage(blocks, "blocks"), "key").withColumn(
        "block", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "key", "fp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("second"))
    return pairs.groupBy("key", "i", "j").applyInArrow(_compare_blocks, "u long, v long")


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links ``u``, ``v`` that connect all fingerprints (column ``fp``, distinct) within 4 bits.

    Not every close pair is listed: of a bucket's links only a spanning forest is kept.
    """
    keyed = fps.mapInArrow(_keyed, "key long, fp long")
    found = stage(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_compare, LINK),
                  "links", by=None)
    return found.where("key is null").select("u", "v").union(
        _large_links(found.where("key is not null").select("key", F.col("u").alias("fp"))))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Fingerprints link at 4 or fewer differing bits; ``component_id`` is the smallest
    ``doc_id`` reachable. Copies share a fingerprint and meet as one row from the start.
    Null, empty and blank texts have fingerprint zero. Rows with null ``doc_id`` keep
    their row and never name a component unless no other id is in it (then null).
    """
    return _named(stage(fingerprints(docs), "fingerprints")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _named(marks: DataFrame) -> DataFrame:
    """``marks`` with the ``component_id`` of their fingerprint."""
    distinct = stage(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = stage(components(fingerprint_links(distinct.select("fp"))), "roots")
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = stage(rooted, "rooted")
    names = stage(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "names")
    named = stage(rooted.join(names, "root").select("fp", "component_id"), "named")
    return marks.join(named, "fp")


def keep_first(docs: DataFrame) -> DataFrame:
    """Keep the row of smallest ``doc_id`` of each component; all columns stay.

    Rows that share that ``doc_id`` are kept with it, and so are rows with null id. Only
    the row whose text is a copy goes, not others of its id.
    """
    def run(batches):
        for b in batches:
            marks, = _fingerprints(iter([b]))
            yield marks.append_column("_th", b.column("_th"))

    marks = _hashed_texts(docs).mapInArrow(run, "doc_id long, fp long, _th long")
    return _without(docs, _named(stage(marks, "fingerprints")))


# ---- near copies by Jaccard similarity

def shingle_set(text: str | None, words: int = COPY_WORDS) -> np.ndarray:
    """Hashes of the distinct shingles of lower-cased (A-Z only) words, ascending."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    n = min(words, len(found))  # a shorter text is one shingle
    joined = map(b" ".join, zip(*(found[k:] for k in range(n))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, joined), dtype=np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A key per band: the smallest hashes of the set under ``BAND_ROWS`` orders; none if empty."""
    if not len(hashes):
        return []
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(hashes), 256):
        least = np.minimum(least, (FACTORS[:, None] * hashes[None, lo:lo + 256]).min(axis=1))
    rows = least.reshape(BANDS, BAND_ROWS)
    keys = [xxhash.xxh64_intdigest(r.tobytes(), seed=k) for k, r in enumerate(rows)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def _banded(words: int, marked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, texts in text_slices(b):
                sizes, marks, bands, fps = [], [], [], []
                for t in texts:  # one set at a time
                    fps.append(fingerprint(t) if marked else 0)
                    own = shingle_set(t, words)
                    sizes.append(len(own))
                    marks.append(xxhash.xxh64_intdigest(own.tobytes()))
                    bands.append(band_keys(own))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("_th"),
                     pa.array(np.array(marks, dtype=np.uint64).view(np.int64)),
                     pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())),
                     pa.array(np.array(fps, dtype=np.uint64).view(np.int64))],
                    names=["doc_id", "_th", "mark", "n", "bands", "fp"])
    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, texts in text_slices(b):
                sets = [shingle_set(t, words).view(np.int64) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("mark"), pa.array(sets, pa.list_(pa.int64()))], names=["mark", "set"])
    return run


def _hashed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and ``_th``, a hash that tells texts of one id apart."""
    return doc_texts(docs).withColumn("_th", F.xxhash64("text"))


def _sized(a: str, b: str, similarity: float) -> Column:
    """Sets further apart in size cannot be similar."""
    return F.least(a, b) >= F.greatest(a, b) * (similarity - 1e-9)


def _open_groups(rows: DataFrame) -> DataFrame:
    """Buckets that hold several components: ``key``, the ``shingles`` of their members and the
    ``blocks`` these are cut into."""
    each = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("here"), F.sum("n").alias("shingles"))
    return each.groupBy("key").agg(
        F.count(F.lit(1)).alias("roots"), F.sum("here").alias("size"), F.sum("shingles").alias("shingles")).where(
        "roots > 1").select("key", "shingles", F.greatest(
            F.ceil(F.col("size") / GROUP_MEMBERS), F.ceil(F.col("shingles") / GROUP_SHINGLES)).cast("int").alias("blocks"))


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set on the left has in common with each on the right, counted for
    the hashes that both sides have, some thousand at a time."""
    counts = np.zeros((len(left), len(right)), dtype=np.float32)  # exact up to 2**24 hashes
    rows, hashes = [], []
    for side in (left, right):
        rows.append(np.repeat(np.arange(len(side)), [len(x) for x in side]))
        hashes.append(np.concatenate(side))
    both = np.intersect1d(*hashes)
    for k in (0, 1):
        at = np.minimum(np.searchsorted(both, hashes[k]), max(len(both) - 1, 0))
        known = both[at] == hashes[k] if len(both) else np.zeros(len(hashes[k]), dtype=bool)
        order = np.argsort(at[known], kind="stable")
        rows[k], hashes[k] = rows[k][known][order], at[known][order]
    for lo in range(0, len(both), SHARED_COLUMNS):
        sides = []
        for k, side in enumerate((left, right)):
            a, b = np.searchsorted(hashes[k], (lo, lo + SHARED_COLUMNS))
            held = np.zeros((len(side), min(SHARED_COLUMNS, len(both) - lo)), dtype=np.float32)
            held[rows[k][a:b], hashes[k][a:b] - lo] = 1
            sides.append(held)
        counts += sides[0] @ sides[1].T
    return counts


def _linked_roots(rows: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray, at: int,
                  similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Components of the similar pairs between members of one bucket, band ``at`` of theirs.

    A pair that shares an earlier band is left to that band's bucket, which is open as well.
    """
    us, vs = [rows["root"][:0]], [rows["root"][:0]]
    same = left is right
    for lo in range(0, len(left), 256):
        a = left[lo:lo + 256]
        n_a, n_b = rows["n"][a][:, None], rows["n"][right][None, :]
        met = rows["root"][a][:, None] != rows["root"][right][None, :]
        met &= np.minimum(n_a, n_b) >= np.maximum(n_a, n_b) * (similarity - 1e-9)
        if same:
            met &= np.arange(lo, lo + len(a))[:, None] < np.arange(len(right))[None, :]
        for k in range(at):
            met &= rows["bands"][a, k][:, None] != rows["bands"][right, k][None, :]
        i, j = np.nonzero(met.any(axis=1))[0], np.nonzero(met.any(axis=0))[0]
        if not len(i):
            continue
        common = _common([rows["set"][x] for x in a[i]], [rows["set"][x] for x in right[j]]).astype(np.float64)
        alike = met[np.ix_(i, j)] & (common / (n_a[i] + n_b[:, j] - common) >= similarity)
        x, y = np.nonzero(alike)
        u, v = forest(rows["root"][a[i[x]]], rows["root"][right[j[y]]])
        us.append(u)
        vs.append(v)
    return forest(np.concatenate(us), np.concatenate(vs))


def _compare_members(similarity: float):
    def run(table: pa.Table) -> pa.Table:
        rows = {c: table.column(c).to_numpy() for c in ("key", "at", "i", "j", "second", "n", "root", "set")}
        rows["bands"] = np.stack(table.column("bands").to_numpy())
        order = np.lexsort((rows["second"], rows["j"], rows["i"], rows["key"]))
        parts = np.stack([rows[c][order] for c in ("key", "i", "j")])
        starts = np.flatnonzero(np.r_[True, (parts[:, 1:] != parts[:, :-1]).any(axis=0)])
        us, vs = [rows["root"][:0]], [rows["root"][:0]]
        for members in np.split(order, starts[1:]):
            left, right = (members[rows["second"][members] == side] for side in (0, 1))
            if rows["i"][members[0]] == rows["j"][members[0]]:
                right = left
            if len(left) and len(right):
                u, v = _linked_roots(rows, left, right, int(rows["at"][members[0]]), similarity)
                us.append(u)
                vs.append(v)
        u, v = forest(np.concatenate(us), np.concatenate(vs))
        return pa.table({"u": u, "v": v})
    return run


def _group_links(rooted: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links ``u``, ``v`` between the components of all similar texts that share a band.

    In every bucket that still holds several components each member meets all those of other
    components, on the whole sets. Large buckets are compared block against block, each pair
    of blocks in its own task; small ones are dealt out many to a task.
    """
    rows = rooted.select("mark", "root", "n", F.posexplode("bands").alias("at", "key"))
    groups = stage(_open_groups(rows), "groups")
    small = groups.where("blocks = 1").agg(F.sum("shingles")).first()[0] or 0
    tasks = max(1, -(-small // GROUP_SHINGLES))
    members = rows.join(groups, "key").select("key", "at", "mark", "blocks").withColumn(
        "block", F.pmod(F.xxhash64("mark"), F.col("blocks")).cast("int"))
    pairs = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "at", "mark", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("second"),
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("key"), F.lit(tasks))).otherwise(
            F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))).alias("task"))
    whole = rooted.select("mark", "n", "root", "bands").join(sets, "mark")
    return pairs.join(whole, "mark").drop("mark").groupBy("task").applyInArrow(
        _compare_members(similarity), "u long, v long")


def _fingerprint_groups(marks: DataFrame) -> DataFrame:
    """Links ``u``, ``v`` of every mark to the group of its texts' fingerprints, those within
    4 bits; groups of one mark are left out."""
    distinct = stage(marks.select("fp").distinct(), "fingerprints")
    roots = stage(components(fingerprint_links(distinct)), "fingerprint_roots")
    groups = stage(marks.select("mark", "fp").distinct().join(roots, F.col("fp") == roots["node"], "left").select(
        "mark", F.xxhash64(F.lit("fp"), F.coalesce("root", "fp")).alias("group")).distinct(), "fingerprint_groups")
    several = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group")
    return groups.join(several, "group").select(F.col("mark").alias("u"), F.col("group").alias("v"))


def near_copies(docs: DataFrame, words: int = COPY_WORDS, similarity: float = SIMILARITY,
                marked: bool = False) -> DataFrame:
    """``doc_id, _th, component_id`` for every row of ``docs``; ``_th`` is its text's hash.

    Texts link if the Jaccard similarity of their sets of shingles of ``words`` words is
    at least ``similarity``; ``component_id`` is as in ``near_duplicates``. Candidates share
    a band of smallest hashes. First each text is verified, on the whole sets, with one
    other: of the heads of its buckets that with which it shares most bands. That leaves one
    component of most groups of copies. Then, in the buckets that still hold several components,
    all pairs of texts of different components are verified (``_group_links``). Equal sets meet
    as one from the start, texts without words too.

    With ``marked`` texts whose SimHash fingerprints are within 4 bits link as well, and first:
    what they connect is of one component before buckets are looked at again.
    """
    texts = _hashed_texts(docs)
    marks = stage(texts.mapInArrow(
        _banded(words, marked), "doc_id long, _th long, mark long, n long, bands array<long>, fp long"), "marks")
    distinct = stage(marks.groupBy("mark").agg(
        F.min("doc_id").alias("first"), F.min("n").alias("n"), F.min("bands").alias("bands"),
        F.min(F.struct("doc_id", "_th")).alias("row")), "distinct")
    banded = distinct.select("mark", "n", F.posexplode("bands").alias("at", "key"))
    buckets = stage(banded.groupBy("key").agg(
        F.min(F.struct("mark", "n")).alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1").select(
        "key", F.col("head.mark").alias("u"), F.col("head.n").alias("n_u")), "buckets")
    members = stage(banded.join(buckets, "key").groupBy("mark", "u").agg(
        F.min("n").alias("n"), F.min("n_u").alias("n_u"), F.count(F.lit(1)).alias("shared")), "members")

    # only texts that share a bucket are looked at again
    shared = stage(members.select("mark").distinct().join(distinct, "mark").select(
        "mark", F.col("row.doc_id").alias("_id"), F.col("row._th").alias("_row_th")), "shared")
    sets = stage(texts.join(shared.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id"))
                            & (F.col("_th") == F.col("_row_th"))).dropDuplicates(["mark"]).select(
        "mark", "text").mapInArrow(_sets(words), "mark long, set array<long>"), "sets")

    def similar(pairs: DataFrame) -> DataFrame:
        common = F.size(F.array_intersect("set_u", "set_v"))
        both = F.size("set_u") + F.size("set_v") - common
        return pairs.join(sets.toDF("u", "set_u"), "u").join(sets.toDF("v", "set_v"), "v").where(
            common / both >= similarity).drop("set_u", "set_v")

    nearest = members.where("mark <> u").where(_sized("n", "n_u", similarity)).groupBy("mark").agg(
        F.max_by("u", F.struct("shared", "u")).alias("u")).select("u", F.col("mark").alias("v"))
    links = stage(similar(stage(nearest, "pairs")), "links")
    if marked:
        links = links.union(stage(_fingerprint_groups(marks), "links"))
    rooted = _rooted(distinct.select("mark", "n", "bands"), "mark", components(links))

    joined = stage(_group_links(rooted, sets, similarity), "links")
    whole = rooted.select("mark", F.col("root").alias("part"))
    if not joined.isEmpty():
        whole = _rooted(whole, "part", components(joined))
    else:
        whole = whole.withColumnRenamed("part", "root")
    named = distinct.select("mark", "first").join(whole.select("mark", "root"), "mark")
    named = stage(named, "rooted")
    names = stage(named.groupBy("root").agg(F.min("first").alias("component_id")), "names")
    named = stage(named.join(names, "root").select("mark", "component_id"), "named")
    return marks.join(named, "mark").select("doc_id", "_th", "component_id")


def _rooted(rows: DataFrame, node: str, roots: DataFrame) -> DataFrame:
    """``rows`` with the ``root`` of their node; a node without edges is its own."""
    found = stage(roots, "roots")
    return stage(rows.join(found, rows[node] == found["node"], "left").select(
        *[rows[c] for c in rows.columns], F.coalesce("root", rows[node]).alias("root")), "rooted")


def keep_first_copy(docs: DataFrame) -> DataFrame:
    """Keep the row of smallest ``doc_id`` of each component of near copies; all columns stay.

    Rows with null id stay. Only the row whose text is a copy goes, not others of its id.
    """
    return _without(docs, near_copies(docs))


def keep_first_alike(docs: DataFrame) -> DataFrame:
    """The same where texts within 4 bits of SimHash are near copies, too."""
    return _without(docs, near_copies(docs, marked=True))


def _without(docs: DataFrame, named: DataFrame) -> DataFrame:
    """``docs`` without the rows (``doc_id``, ``_th``) that are not of their component's id."""
    copies = stage(named.where("doc_id <> component_id").select(
        F.col("doc_id").alias("_copy_id"), F.col("_th").alias("_copy_th")).distinct(), "copies")
    return packed_rows(docs).join(copies.hint("merge"), (F.col("_id") == F.col("_copy_id"))
                                  & (F.col("_th") == F.col("_copy_th")), "left_anti").select("_row.*")
