"""Byte-level BPE by prefix dynamic programming, and its inverse.

For each prefix of a piece there is exactly one token that ends the prefix's encoding.
The table of these last tokens is built left to right: token ``t`` ends a prefix if it
may follow the token that ends what is left of the prefix without ``t``. Appending bytes
extends the table; an edit recomputes it from the edit until it agrees with the old one.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from sluice.llm.common import text_slices

MEMO_PIECES = 450_000  # pieces a worker remembers beyond those of the texts at hand
SLICE = 3_000_000  # characters of text at hand, one text at least
NEVER = 1 << 32  # later than any rank


class Bpe:
    """Encoder and decoder for a vocabulary of byte strings with merge ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.words = {rank: word for word, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._spines: dict[int, tuple | None] = {}
        self._follows: dict[tuple[int, int], bool] = {}

    @classmethod
    def from_lines(cls, content: bytes) -> Bpe:
        """Read a rank file: base64 of the token, a blank, the rank."""
        pairs = (line.split() for line in content.splitlines() if line.strip())
        return cls({base64.b64decode(word): int(rank) for word, rank in pairs})

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``, or None if merging never makes it."""
        word = self.words[token]
        parts = [self.ranks.get(word[i:i + 1], NEVER) for i in range(len(word))]
        while len(parts) > 1:
            merged = [self.ranks.get(self.words[a] + self.words[b], NEVER)
                      if a < NEVER and b < NEVER else NEVER for a, b in zip(parts, parts[1:])]
            best = min(merged)
            if best == NEVER:
                return None
            at = merged.index(best)
            if len(parts) == 2:
                return (parts[0], parts[1]) if best == token else None
            parts[at:at + 2] = [best]
        return None

    def _spine(self, token: int) -> tuple[list[int], list[int]] | None:
        """Tokens that stand first and last while ``token`` is merged, smallest first.

        None for a token that merging never makes from its own bytes.
        """
        if token not in self._spines:
            if len(self.words[token]) == 1:
                self._spines[token] = ([token], [token])
            elif (halves := self._halves(token)) is None:
                self._spines[token] = None
            else:
                left, right = self._spine(halves[0]), self._spine(halves[1])
                self._spines[token] = None if left is None or right is None else (
                    left[0] + [token], right[1] + [token])
        return self._spines[token]

    def follows(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` leaves the two tokens apart.

        Walks the tokens that touch the border over time. They merge across it if the
        pair's rank comes before the one, and not after the other, is merged away; of
        equal ranks the leftmost pair merges first.
        """
        known = self._follows.get((a, b))
        if known is None:
            known = self._follows[a, b] = self._apart(a, b)
        return known

    def _apart(self, a: int, b: int) -> bool:
        left, right = self._spine(a), self._spine(b)
        if left is None or right is None:
            return False
        left, right = left[1], right[0]
        i = j = 0
        while True:
            next_left = left[i + 1] if i + 1 < len(left) else NEVER
            next_right = right[j + 1] if j + 1 < len(right) else NEVER
            rank = self.ranks.get(self.words[left[i]] + self.words[right[j]], NEVER)
            if rank < next_left and rank <= next_right and rank < NEVER:
                return False
            if next_left == next_right == NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def prefix_table(self, data: bytes) -> list[int]:
        """``table[i]`` is the last token of ``data[:i]``; ``table[0]`` is unused."""
        return self.append([-1], b"", data)

    def append(self, table: list[int], data: bytes, more: bytes) -> list[int]:
        """The table of ``data + more``, from that of ``data``."""
        out = list(table)
        self._fill(out, data + more, len(data) + len(more))
        return out

    def _fill(self, out: list[int], data: bytes, stop: int) -> None:
        """Extend a table in place until it covers ``data[:stop]``."""
        rank_of, known, longest = self.ranks.get, self._follows.get, self.longest
        for end in range(len(out), stop + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = rank_of(data[start:end])
                if token is None:
                    continue
                if start:
                    fits = known((out[start], token))
                    if fits is None:
                        fits = self.follows(out[start], token)
                else:
                    fits = self._spine(token) is not None
                if fits:
                    out.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def replace(self, table: list[int], data: bytes, start: int, stop: int,
                new: bytes) -> tuple[list[int], int]:
        """The table after ``data[start:stop]`` became ``new``, and how many entries it took.

        Once as many entries in a row as the longest token has bytes agree with the old
        table, all further ones do.
        """
        whole = data[:start] + new + data[stop:]
        shift, out, agree = len(whole) - len(data), table[:start + 1], 0
        for end in range(start + 1, len(whole) + 1):
            self._fill(out, whole, end)
            token = out[-1]
            inside = end - self.longest >= start + len(new)
            agree = agree + 1 if inside and table[end - shift] == token else 0
            if agree >= self.longest:
                return out + table[end - shift + 1:], end - start
        return out, len(whole) - start

    def tokens(self, table: list[int]) -> list[int]:
        """Read a table backwards into the ids of the whole piece."""
        out, end = [], len(table) - 1
        while end > 0:
            out.append(table[end])
            end -= len(self.words[table[end]])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.tokens(self.prefix_table(piece))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.words.__getitem__, ids))


class PieceMemo(dict):
    """Packed ids by piece, for one worker; when full it forgets what is not at hand."""

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe = bpe

    def learn(self, pieces: set[str], limit: int = MEMO_PIECES) -> None:
        """Encode the pieces not known yet, in byte order, so that neighbours share prefixes."""
        fresh = pieces.difference(self)
        if len(self) + len(fresh) > limit:
            used = {p: self[p] for p in pieces if p in self}
            self.clear()
            self.update(used)
        bpe, before, table = self.bpe, b"", [-1]
        for data, piece in sorted((p.encode("utf-8", "surrogatepass"), p) for p in fresh):
            whole = bpe.ranks.get(data)
            if whole is not None:
                ids = [whole]
            else:
                same = shared_prefix(before, data)
                del table[same + 1:]
                bpe._fill(table, data, len(data))
                before, ids = data, bpe.tokens(table)
            self[piece] = struct.pack(f"<{len(ids)}I", *ids)


def shared_prefix(a: bytes, b: bytes) -> int:
    """Number of leading bytes two strings share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n - 1  # the first lo agree, the first hi + 1 do not
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


_ready: dict[bytes, PieceMemo] = {}  # kept by a worker process, by digest of the vocabulary


def _memo(content: Broadcast) -> PieceMemo:
    digest = hashlib.sha256(content.value).digest()
    if digest not in _ready:
        _ready.clear()
        _ready[digest] = PieceMemo(Bpe.from_lines(content.value))
    return _ready[digest]


FIELDS = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int64()),
          "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
FIELD_SQL = {"n_tokens": "long", "ids": "array<long>", "ids_sha256": "string",
             "decoded_sha256": "string"}


def _fields(packed: bytes, words: dict[int, bytes], wanted: list[str]) -> Iterator:
    """What is known of one encoded text, in the order wanted."""
    ids = np.frombuffer(packed, dtype="<u4")
    for name in wanted:
        if name == "n_tokens":
            yield len(ids)
        elif name == "ids":
            yield ids.astype(np.int64)
        elif name == "ids_sha256":
            yield hashlib.sha256(packed).hexdigest()
        else:
            yield hashlib.sha256(b"".join(map(words.__getitem__, ids.tolist()))).hexdigest()


def _encoder(content: Broadcast, pattern: str, wanted: list[str], pieces_kept: int, chars: int) -> Callable:
    """A batch function that adds the wanted fields to every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, cut = _memo(content), regex.compile(pattern)
        for batch in batches:
            for part, texts in text_slices(batch, limit=chars):
                split = [cut.findall(text or "") for text in texts]
                memo.learn(set().union(*split), pieces_kept)
                rows = [_fields(b"".join(map(memo.__getitem__, pieces)), memo.bpe.words, wanted)
                        for pieces in split]
                made = [pa.array(c, FIELDS[f]) for c, f in zip(zip(*rows), wanted)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made],
                                                 names=[*part.schema.names, *wanted])
    return run


def encode(docs: DataFrame, vocabulary: str, pattern: str,
           fields: tuple[str, ...] = ("n_tokens", "ids"), pieces_kept: int = MEMO_PIECES,
           chars: int = SLICE) -> DataFrame:
    """All rows and columns of ``docs``, and the ``fields`` of every whole text encoded.

    ``vocabulary`` is the path of a rank file, read once here and sent to the tasks (its
    size is that of the vocabulary, whatever the corpus). Each match of ``pattern`` is
    encoded by itself. Fields: ``n_tokens``, ``ids``, ``ids_sha256`` (of the ids as
    little-endian 32-bit numbers) and ``decoded_sha256`` (of the bytes the ids decode
    to). A null text counts as empty and has no ids. Columns of ``docs`` that bear a
    field's name give way to it. A worker remembers ``pieces_kept`` pieces and works on
    ``chars`` characters at a time; both only trade memory for time.
    """
    with open(vocabulary, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.drop(*fields)
    schema = StructType(rows.schema.fields + StructType.fromDDL(
        ", ".join(f"{f} {FIELD_SQL[f]}" for f in fields)).fields)
    return rows.mapInArrow(_encoder(content, pattern, list(fields), pieces_kept, chars), schema)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Turn ``ids`` back into texts: ``doc_id, text``; bytes that are no UTF-8 show as U+FFFD."""
    with open(vocabulary, "rb") as f:
        content = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        words = _memo(content).bpe.words
        for b in batches:
            texts = [b"".join(map(words.__getitem__, ids or ())).decode("utf-8", "replace")
                     for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
