"""Secrets in texts: fixed patterns, and Markov models of random strings and identifiers.

Values that the patterns find are the labelled sample of random strings, one model per
alphabet they are drawn from; other identifiers of the corpus are that of ordinary ones, save
those that change between letters and digits so often that they may be secrets themselves.
Characters follow one another with probabilities counted over all documents. A further
identifier is reported if the best random model makes it likelier than the ordinary one by
``MIN_LLR`` nats.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import doc_texts

ASSIGN, ACCESS, HEX, MARKOV = "assign", "access", "hex", "markov"
BASE = (ASSIGN, ACCESS, HEX)
KINDS = (*BASE, MARKOV)

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
MIN_ASSIGNED, MIN_ACCESS = 6, 20

_IDENTIFIER = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
_CHANGE = re.compile(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])")
MAX_CHANGES = 2  # between letters and digits, in an identifier taken for an ordinary one
MIN_LENGTH = 16  # of an identifier the models may report
MIN_LLR = 15.0  # nats by which the random model must be likelier, in all ...
MIN_LLR_PER_CHAR = 0.5  # ... and on average per character
SMOOTHING = 20.0  # counts each state starts with, spread over the alphabet

ALPHABET = string.ascii_letters + string.digits + "+/_.=-"
SAMPLES = (re.compile("[0-9a-f]+"), re.compile("[A-Z0-9]+"), re.compile(".+"))  # alphabets of secrets
_SIZE = len(ALPHABET) + 1
_START = len(ALPHABET)
_SYMBOL = np.full(256, _START, np.int64)
_SYMBOL[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))

SPAN_TYPE = "array<struct<kind:string,start:long,end:long>>"


def base_matches(text: str) -> list[tuple[int, int, int, str]]:
    """Matches of the fixed patterns: ``(start, kind's place, end, secret value)``, in order."""
    out = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        out += [(m.start(), 0, m.end(), m.group(2)) for m in _ASSIGN.finditer(text)
                if len(m.group(2)) >= MIN_ASSIGNED]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.group()) for m in _ACCESS.finditer(text)
                if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end(), m.group()) for m in _HEX.finditer(text)]
    return sorted(out)


def identifiers(text: str, base: list[tuple], shortest: int) -> Iterator[re.Match]:
    """Identifiers of at least ``shortest`` characters that overlap no base match."""
    at, until = 0, 0
    for m in _IDENTIFIER.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            until = max(until, base[at][2])
            at += 1
        if m.start() >= until and m.end() - m.start() >= shortest:
            yield m


def _symbols(strings: list[str]) -> np.ndarray:
    """Symbols of all strings, each after a start symbol."""
    return _SYMBOL[np.frombuffer(("\0" + "\0".join(strings)).encode(), np.uint8)]


def transitions(strings: list[str]) -> np.ndarray:
    """How often each symbol follows each, over all strings."""
    if not strings:
        return np.zeros((_SIZE, _SIZE), np.int64)
    s = _symbols(strings)
    pair = (s[:-1] * _SIZE + s[1:])[s[1:] != _START]
    return np.bincount(pair, minlength=_SIZE * _SIZE).reshape(_SIZE, _SIZE)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((len(SAMPLES) + 1, _SIZE, _SIZE), np.int64)
    for b in batches:
        seen: list[list[str]] = [[] for _ in range(len(SAMPLES) + 1)]
        for value in b.column("text"):
            text = value.as_py()
            base = base_matches(text)
            for *_, secret in base:
                seen[next(k for k, a in enumerate(SAMPLES) if a.fullmatch(secret))].append(secret)
            seen[-1] += [x for m in identifiers(text, base, 1)
                         if len(_CHANGE.findall(x := m.group())) <= MAX_CHANGES]
        for kind, strings in enumerate(seen):
            total[kind] += transitions(strings)
    cells = np.nonzero(total.ravel())[0]
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], names=["cell", "n"])


class Models:
    """Log-likelihood ratios of every transition: one table per alphabet that has a sample."""

    def __init__(self, counts: np.ndarray):
        shape = (len(SAMPLES) + 1, _SIZE, _SIZE)
        counts = counts.reshape(shape)[:, :, :_START].astype(float)
        even = SMOOTHING / _START
        logs = np.log((counts + even) / (counts.sum(axis=2, keepdims=True) + SMOOTHING))
        present = [k for k in range(len(SAMPLES)) if counts[k].sum()]
        self.ratios = [np.pad(logs[k] - logs[-1], ((0, 0), (0, 1))) for k in present]

    def llr(self, strings: list[str]) -> np.ndarray:
        """Per string the largest log-likelihood ratio of a random model to the ordinary one."""
        if not strings or not self.ratios:
            return np.full(len(strings), -np.inf)
        s = _symbols(strings)
        starts = np.nonzero(s[:-1] == _START)[0]
        return np.max([np.add.reduceat(r[s[:-1], s[1:]], starts) for r in self.ratios], axis=0)

    def secret(self, strings: list[str]) -> np.ndarray:
        llr = self.llr(strings)
        return (llr >= MIN_LLR) & (llr >= MIN_LLR_PER_CHAR * np.array([len(x) for x in strings]))


def learn(docs: DataFrame) -> Models:
    """Models from all documents; only the counts, bounded by the alphabet, are collected."""
    rows = doc_texts(docs).mapInArrow(_count, "cell long, n long").groupBy("cell").agg(
        F.sum("n").alias("n")).collect()
    counts = np.zeros((len(SAMPLES) + 1) * _SIZE * _SIZE, np.int64)
    for r in rows:
        counts[r["cell"]] = r["n"]
    return Models(counts)


def _scan(models: Models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans: list[list[tuple]] = []
            asked: list[tuple[int, re.Match]] = []
            for i, value in enumerate(b.column("text")):
                text = value.as_py()
                base = base_matches(text)
                spans.append([(start, kind, end) for start, kind, end, _ in base])
                asked += [(i, m) for m in identifiers(text, base, MIN_LENGTH)]
            for (i, m), yes in zip(asked, models.secret([m.group() for _, m in asked])):
                if yes:
                    spans[i].append((m.start(), len(BASE), m.end()))
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(own)] for own in spans]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])
    return run


def secrets(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end; code points, end exclusive) of each row.

    Spans are sorted by start, then as ``KINDS`` lists them. Null texts are empty; ids may be
    null or repeat, every row is answered. Without any match of the patterns in the corpus
    there is nothing to learn from and nothing is added. Further columns are ignored.
    """
    models = models or learn(docs)
    return doc_texts(docs).mapInArrow(_scan(models), f"doc_id long, spans {SPAN_TYPE}")


def joined(spans: Column) -> Column:
    """Spans as text: ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts per pattern, digest of the pattern's spans, and all spans as text."""
    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(of(*BASE)).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
