"""Conversation repair, periodic runs and secret scans against brute force on small tables."""
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sluice.llm import dialogue, periodic, secretscan

# ---- 13: conversations

CONV_TYPE = "conv_id long, turn long, role string, text string, block int, n string, last string"


def shown(value):
    return " " if value is None else str(value)


def plain_damage(rows):
    """Rows per conversation after damage, in the order the operator states."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """Cheapest repair by trying all edits, a row and a role at a time (no bounds, no stack)."""
    said, faults = set(), []
    for _, role, text in rows:
        t = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not t else "duplicate" if (role, text) in said else
                      "truncated" if t[-1] not in ".!?" else "")
        said.add((role, text))
    # all (cost, audit) per (initials' end) after each row, up to two inserts before each
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserts(found):
        new = dict(found)
        for _ in range(2):
            for q, (cost, audit, lines) in list(new.items()):
                to = after[q]
                made = (cost + 2, audit + "I", lines + [name[to] + ":"])
                if to not in new or made[:2] < new[to][:2]:
                    new[to] = made
        return new

    found = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for q, (cost, audit, lines) in inserts(found).items():
            options = [("D", 3, q, None)]
            extra = fault == "truncated"
            if fault not in ("blank", "duplicate"):
                if role[:1] == after[q] or (role[:1] == "s" and q == ""):
                    options.append(("K", extra, role[:1], role))
                options.append(("R", 2 + extra, after[q], name[after[q]]))
            for edit, more, to, now in options:
                made = (cost + more, audit + edit, lines + ([f"{now}:{text}"] if now else []))
                if to not in new or made[:2] < new[to][:2]:
                    new[to] = made
        found = new
    ends = inserts(found)
    cost, audit, lines = min((ends[q] for q in ("", "a") if q in ends), key=lambda x: x[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(rows, rows[1:])]
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role)


def conversations(seed, many):
    rng = random.Random(seed)
    said = ["Good day.", "And then?", "cut off in the", "", " \n", "Yes!", "ünï cödé…", "a. b! c?", "x" * 3000 + "."]
    rows = []
    for conv in range(many):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            role = rng.choice(["system", "tool", "", None, " "]) if rng.random() < 0.1 else role
            text = None if rng.random() < 0.03 else rng.choice(said) if rng.random() < 0.4 else f"no {rng.random()}."
            rows.append((conv, turn * rng.choice([1, 1, 2]) if rng.random() < 0.95 else None, role, text))
    return rows


@pytest.mark.parametrize("block_rows", [dialogue.BLOCK_ROWS, 3])
def test_conversations_like_brute_force(spark, block_rows):
    rows = conversations(5, 300)
    rows += [(None, 1, "user", "Who?"), (None, 2, "assistant", "Me."), (None, None, None, None)]
    long = [(7777, t, ("user", "assistant")[t % 2] if t % 17 else "system", f"t {t % 90}" + "." * (t % 5 > 0))
            for t in range(400)]
    rows += long + [(8888, 1, "user", "same.")] * 30
    # equal turns are ordered by a hash of the text, so brute force takes one text per (turn, role)
    unique = {(c, t, r if zlib.crc32(f"{shown(c)}:{shown(t)}".encode()) % 20 != 4 else "user"): x for c, t, r, x in rows}
    rows = [(c, t, r, x) for c, t, r, x in rows
            if unique[c, t, r if zlib.crc32(f"{shown(c)}:{shown(t)}".encode()) % 20 != 4 else "user"] == x]
    df = spark.createDataFrame([(*r, 1, "n", "l") for r in rows], CONV_TYPE).repartition(3)
    got = {r["conv_id"]: tuple(r)[1:] for r in dialogue.repaired(df, block_rows).collect()}
    want = {c: plain_repair(sorted(kept, key=plain_order)) for c, kept in plain_damage(rows).items()}
    assert len(got) == len(want)
    for conv in want:
        assert got[conv] == want[conv], conv
    assert dialogue.repaired(df, block_rows).columns == ["conv_id", *dialogue._FIELDS]


def test_conversations_without_rows(spark):
    lost = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(5, lost, "user", "Gone.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in dialogue.repaired(df).collect()] == [
        (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert dialogue.repaired(df.limit(0)).collect() == []


def test_search_finds_the_least_audit_of_least_cost():
    """All audits of up to nine edits are spelled out for short rows."""
    codes_of = [(i, f) for i in ("s", "u", "a", "") for f in range(4)]
    rng = random.Random(2)
    for _ in range(150):
        codes = [rng.choice(codes_of) for _ in range(rng.randrange(0, 5))]
        best, todo = None, [(0, "", 0, dialogue.NOTHING)]
        while todo:
            i, audit, cost, q = todo.pop()
            if i == len(codes) and q in (dialogue.NOTHING, dialogue.ASSISTANT):
                best = min(best or (cost, audit), (cost, audit))
            if len(audit) < 9:
                todo.append((i, audit + "I", cost + 2, dialogue.AFTER_SPEECH[q]))
                if i < len(codes):
                    todo += [(i + 1, audit + e, cost + c, to) for e, c, to in dialogue.moves(q, *codes[i])]
        assert dialogue.repair(codes)[:2] == best


# ---- 11: periodic runs

def words_of(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def plain_runs(words):
    """Every maximal stretch per period, by comparing all words; smallest periods only."""
    n, runs = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                runs.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in runs.items())


def plain_periodic(doc_id, text):
    words = words_of(doc_id, text)
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else [None] * 4),
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def run_texts():
    rng = random.Random(11)
    out = [None, "", " \n\t", "one", "a a a a a a", "a a a a a", "x " + "b c " * 4 + "d", "日本 語 " * 9, "b c " * 3 + "b c"]
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            unit = [rng.choice("abcd") for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 40]))]
            parts += unit * rng.choice([1, 2, 4, 5, 9]) + unit[:rng.randrange(len(unit))]
        out.append(" ".join(parts))
    out += [" ".join(rng.choice("ab") for _ in range(n)) for n in (50, 200, 700)]
    unit = [f"w{i}" for i in range(37)]
    out.append(" ".join(unit * 400))  # several tiles
    out.append(" ".join(["same"] * 9000))
    long = [f"v{i}" for i in range(1500)]
    out.append("intro " + " ".join(long * 5 + long[:700]) + " outro")
    return out + out[20:30]


def test_runs_like_brute_force(spark):
    texts = run_texts()
    rows = [(i, t, 1, "p") for i, t in enumerate(texts)]
    periodic_id = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows += [(periodic_id, " ".join(f"k{i}" for i in range(500)), 1, "p"), (None, "z z z z z z z", 1, "p"),
             (3000, "q q q q q q", 1, "p"), (3000, "q q q q q q", 1, "p"), (3000, "r s", 1, "p"), (None, None, 1, "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int, kind string").repartition(3)
    got = sorted(map(tuple, periodic.periodic_runs(docs).collect()), key=str)
    want = sorted((plain_periodic(i, t) for i, t, _, _ in rows), key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == b
    assert periodic.periodic_runs(docs.limit(0)).collect() == []


def test_small_tiles_are_stitched(spark, monkeypatch):
    """Tiles of 16 words: every longer run lies over many of them."""
    monkeypatch.setattr(periodic, "TILE_WORDS", 16)
    import numpy as np
    for seed in range(40):
        rng = random.Random(seed)
        unit = [rng.randrange(4) for _ in range(rng.randrange(1, 12))]
        words = [rng.randrange(4) for _ in range(rng.randrange(30))] + unit * 15 + [9] + [rng.randrange(3)] * rng.randrange(20)
        numbers = np.array([*words, -1, *words[::-1], -2], np.int32)
        found = {0: {}, 1: {}}
        for d, p, start, anchors, ids in periodic.tiles(numbers, np.array([len(words), 2 * len(words) + 1])):
            for c in anchors:
                for q, s, e in periodic.equal_stretches(ids.tolist(), c, p):
                    found[d].setdefault(q, set()).update(range(start + s, start + e))
        for d, own in ((0, words), (1, words[::-1])):
            runs = []
            for q, places in found[d].items():
                at = sorted(places)
                while at:
                    k = next((k for k in range(1, len(at)) if at[k] != at[k - 1] + 1), len(at))
                    if k + q >= max(6, 4 * q):
                        runs.append((at[0], k + q, q))
                    at = at[k:]
            assert sorted(runs) == plain_runs(own)


# ---- 12: secrets

def plain_base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text)
        if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(secretscan.BASE[k], s, e) for s, k, e in sorted(found)]


def secret_texts():
    rng = random.Random(4)

    def rand(chars, n):
        return "".join(rng.choice(chars) for _ in range(n))

    hexes, upper = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    every = "abcdefghijklmnopqrstuvwxyz" + upper
    words = ["configuration", "responsibility", "understanding_of", "documentOperator", "internationalisation",
             "get_customer_address", "temperature", "numberOfElements", "environment_variable", "perpendicular"]
    texts = [None, "", "token=short", "token:token:abcdefgh", "TOKEN = 'Abcdef.gh-' and apikey:\"zzzzzz\"",
             "passſword=abcdefgh toKen=abcdefgh", "😀 api_key = abcdefghij", "AKIA" + "A" * 15 + " AKIA" + "B" * 16,
             "secret  =  \"" + rand(hexes, 40) + "\"", "beef " * 7 + rand(hexes, 24) + " " + rand(hexes, 9), "Password: " + rand(hexes, 30)]
    for _ in range(400):
        line = [rng.choice(words) for _ in range(30)]
        line.insert(9, f'token = "{rand(hexes, 40)}"')
        line.insert(20, f"password={rand(every, 20)}")
        texts.append(" ".join(line))
    return texts, [rand(every, 32) for _ in range(60)], words, rng


def test_secrets(spark):
    texts, hidden, words, rng = secret_texts()
    planted = {}
    rows = [(i, t, 0, "k") for i, t in enumerate(texts)]
    for k, value in enumerate(hidden):
        before = "é" + " ".join(rng.choice(words) for _ in range(5)) + " <"
        planted[10_000 + k] = (len(before), len(before) + len(value))
        rows.append((10_000 + k, before + value + "> " + " ".join(rng.choice(words) for _ in range(5)), 0, "k"))
    rows += [(None, "token=abcdefgh", 0, "k"), (7, "token=abcdefgh", 0, "k"), (7, "token=abcdefgh", 0, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int, kind string").repartition(3)
    found = secretscan.report(secretscan.secrets(docs))
    assert found.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    got = found.collect()

    def base_row(doc_id, text):
        base = plain_base(text)
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        return (doc_id, *(sum(b[0] == k for b in base) for k in secretscan.BASE), hashlib.sha256(line.encode()).hexdigest())

    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted((base_row(i, t) for i, t, _, _ in rows), key=str)
    caught = 0
    for r in got:
        own = [s for s in r["spans"].split(",") if s.startswith("markov")]
        if r["doc_id"] in planted:
            caught += own == ["markov:%d:%d" % planted[r["doc_id"]]]
        else:
            assert own == []
    assert caught >= 0.9 * len(planted)
    assert secretscan.secrets(docs.limit(0)).collect() == []
    nothing = secretscan.secrets(docs.where(F.col("doc_id") >= 10_000)).collect()
    assert all(r["spans"] == [] for r in nothing)


def test_ratio_is_the_sum_over_characters():
    import math

    import numpy as np

    samples = {0: ["aXbXaX"], 3: ["abcabc", "bca"]}
    counts = np.zeros((len(secretscan.SAMPLES) + 1, secretscan._SIZE, secretscan._SIZE), np.int64)
    for k, strings in samples.items():
        counts[k] = secretscan.transitions(strings)

    def log(k, before, char):
        seen = [x for s in samples[k] for x in zip(["^", *s], s) if x[0] == before]
        even = secretscan.SMOOTHING / len(secretscan.ALPHABET)
        return math.log((sum(x[1] == char for x in seen) + even) / (len(seen) + secretscan.SMOOTHING))

    asked = ["abX", "cab", "X"]
    want = [sum(log(0, a, b) - log(3, a, b) for a, b in zip("^" + s, s)) for s in asked]
    assert np.allclose(secretscan.Models(counts).llr(asked), want)
