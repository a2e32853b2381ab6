"""Corpus operators against brute force on small tables with awkward rows."""
import hashlib
import random
import struct

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from sluice.llm import (bpe, components, decontam, langid, linedup, quality, simhash, substring, topk,
                        toxicity, warc)

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOC_TYPE = "doc_id long, text string, lang string, source string, n_chars long, fp string, _gone int"


def prose(rng, words, vocabulary=None):
    return " ".join(rng.choice(vocabulary or ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta"])
                    for _ in range(words))


def awkward_texts():
    rng = random.Random(7)
    names = [f"w{i}" for i in range(400)]
    passage = "\n".join(prose(rng, 12, names) for _ in range(9))
    body = prose(rng, 120, names)
    return [
        "plain start " + body, passage, None, "", "  \n\t ", "x", body, body, body + " tail",
        "intro line\n" + passage + "\nlast words here", "other intro\n\n" + passage,
        prose(rng, 30_000, names), "\n" * 50, "a\nb\na\nb\na\nb", "日本語 текст ß 😀 é", "12 345,6 !! ...",
        "one two three", "one two three", prose(rng, 80, names) + " " + body, "Q" * 5000,
        body.replace("w1 ", "w2 ", 1), "wORDS " + body.upper()]


def docs_of(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None, "s", None, "clash", 1) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOC_TYPE).repartition(3)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def texts():
    return awkward_texts()


# ---- components

def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)]
    got = {r["node"]: r["root"] for r in components.components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    loops = {a for a, b in edges if a == b}
    assert {n: r for n, r in root.items() if n in got} == got
    assert all(n in loops for n in set(root) - set(got))


# ---- 1

BENCH = "item_id long, text string"


def test_decontamination(spark):
    rng = random.Random(1)
    item = "Anna bought 12 kg of ripe apples and then sold 5 kg of those same apples to Ben near the old market"
    asked_again = item.replace("12", "30").replace("5", "8").replace("Anna", "Carla").replace("Ben", "David")
    broken = ("Anna walked 3 miles and then Anna walked 3 miles more until Anna was very tired from the long walk")
    mixed = ("Carla walked 4 miles and then Dora walked 9 miles more until Emma was very tired from the long walk")
    clean = prose(rng, 60)
    bench = spark.createDataFrame(
        [(7, item), (9, item), (8, broken), (None, item), (10, None), (11, ""), (12, "too short"),
         (13, "just six plain words in here")], BENCH)
    docs = docs_of(spark, [clean, clean + " " + item + " " + clean, asked_again, mixed, item.lower(), None, "",
                           "well just six plain words in here then", clean + " ripe apples " + clean,
                           asked_again], [0, 1, 2, 3, 4, 5, 6, 7, 8, None])
    want = {(1, 7, True), (2, 7, False), (4, 7, True), (7, 13, True)}
    for bound in (decontam.BROADCAST_WINDOWS, 0):
        got = decontam.contaminated(docs, bench, broadcast_windows=bound).collect()
        assert {(r["doc_id"], r["item_id"], r["exact"]) for r in got} == want
        assert all(0.5 <= r["coverage"] <= 1 for r in got)
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        (False, 0), (False, 3), (False, 5), (False, 6), (False, 8), (True, 0)]
    assert decontam.contaminated(docs.limit(0), bench).count() == 0
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0


def asked_in(spark, pairs):
    """For each pair of an item and a document whether the one is found in the other."""
    bench = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], BENCH)
    got = decontam.contaminated(docs_of(spark, [b for _, b in pairs]), bench).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    return [(i, i) in found for i in range(len(pairs))]


def test_items_dense_in_slots_short_items_and_scripts_without_blanks(spark):
    assert asked_in(spark, [
        ("What is 12 plus 7?", "so tell me What is 30 plus 4? I think 34"),
        ("Solve 3x + 5 = 20 for x.", "now Solve 7x + 2 = 16 for x. and check"),
        ("John pays 5 dollars for 2 kg of rice and 3 dollars for 4 kg of beans.",
         "hear this: Mary pays 8 dollars for 3 kg of rice and 6 dollars for 9 kg of beans. what now"),
        ("capital of France", "it is the capital of france they say"),
        ("日本で一番高い山は何ですか", "問題です。日本で一番高い山は何ですか。答えて"),
        ("capital of Peru", "the capital of old Peru"),
        ("Add 12 and 30, 41 or 52", "nothing but 1 2 3 4 5 6 7 8 9 and 10 11"),
        ("日本で一番高い山は何ですか", "日本の山は高いですか、何が一番好き")]) == [True] * 5 + [False] * 3


def test_slots_that_changed_unevenly(spark):
    again = "A farmer sold {} apples at noon and {} pears at night to {} and then {} plums went to waste"
    short = "Then {} gave away all of the {} red marbles"
    assert asked_in(spark, [
        (again.format(3, 5, "Ben", 9), "x " + again.format(4, 4, "Tom", 6) + " y"),
        (again.format(3, 3, "Ben", 9), "x " + again.format(4, 7, "Tom", 6) + " y"),
        (short.format("Ann Smith", 3), "x " + short.format("Bob", 9) + " y"),
        (short.format("Ann", 3), "x " + short.format("Jean Luc Picard", 9) + " y")]) == [True] * 4


# ---- 2

def test_language_mixtures(spark):
    rng = random.Random(5)
    spell = {"aa": ["banana", "kanala", "tamara", "anagama"], "oo": ["boogo", "noomo", "toroko", "moloko"]}
    rows = []
    for i in range(200):
        lang = "aa" if i % 2 else "oo"
        rows.append((i, prose(rng, 60, spell[lang]), lang, "s", None, "", 0))
    rows += [(1000, None, "aa", "s", None, "", 0), (1001, "", "aa", "s", None, "", 0),
             (1002, "12 34 !?", "oo", "s", None, "", 0), (1003, prose(rng, 200, spell["aa"]) + " " +
              prose(rng, 100, spell["oo"]), None, "s", None, "", 0), (None, "banana", None, "s", None, "", 0),
             (1004, "a", None, None, None, "", 0)]
    docs = spark.createDataFrame(rows, DOC_TYPE)
    got = by_id(langid.identify(docs))
    assert all(got[i]["lang_pred"] == ("aa" if i % 2 else "oo") for i in range(200))
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert set(got[1003]["mixture"]) == {"aa", "oo"}
    assert got[1003]["mixture"]["aa"] == pytest.approx(2 / 3, abs=0.1)
    assert len(got) == len(rows)
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    unlabelled = langid.identify(docs.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang"))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0


# ---- 3

def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, .3, 6)]) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(20)]  # ties
    rows += [(600, None), (650, [None] + [1.0] * 5), (700, [float("nan")] * 6), (750, [float("inf")] * 6),
             (800, []), (850, [0.0] * 6), (None, [1.0] * 6), (900, [0.5, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    usable = {i: [int(np.floor(256 * np.float64(np.float32(x)))) for x in v] for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in usable if i % 50 == 0):
        score = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(score[:5])}
    got = topk.top_k(vectors, F.col("vec_id") % 50 == 0)
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == want
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("spread", [1, 3, 400])
def test_reading_lists_finds_the_best(spread):
    rng = np.random.default_rng(spread)
    rows = rng.integers(-spread, spread + 1, (500, 5))
    lists = topk.Lists(rows, np.arange(500)[::-1].copy())
    for q in range(40):
        own = np.arange(500) == q
        at, score = lists.best(rows[q], own, 5)
        want = sorted((-int(rows[i] @ rows[q]), 499 - i) for i in range(500) if i != q)[:5]
        assert [(-s, i) for s, i in zip(score.tolist(), lists.ids[at].tolist())] == want


# ---- 4

def test_merkle_audit(spark):
    rows = [(i, f"http://h/{i}", f"<p>{'x' * (i * 37 % 900)}</p>") for i in range(1500)]
    rows += [rows[3], (None, "u", "h"), (None, None, None), (5, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    a = warc.manifest(warc.page_records(pages))
    assert a.count() == 1503
    ends = a.selectExpr("archive", "offset", "offset + length AS stop").collect()
    stops = {(r["archive"], r["stop"]) for r in ends}
    assert all(r["offset"] == 0 or (r["archive"], r["offset"]) in stops for r in ends)
    assert warc.audit(a, a).count() == 0
    b = a.where("page_id IS NULL OR page_id <> 700").selectExpr(
        "archive", "offset", "CASE WHEN page_id = 900 THEN length + 1 ELSE length END AS length",
        "CASE WHEN page_id = 1200 THEN 'f00' ELSE digest END AS digest")
    b = b.union(spark.createDataFrame([(77, 0, 5, "new")], b.schema))
    place = {r["page_id"]: (r["archive"], r["offset"]) for r in a.collect()}
    got = {(r["archive"], r["offset"]): r["status"] for r in warc.audit(a, b).collect()}
    assert got == {place[700]: "missing", place[900]: "altered", place[1200]: "altered", (77, 0): "extra"}
    assert warc.audit(a.limit(0), a.limit(0)).count() == 0
    assert warc.audit(a, a.limit(0)).count() == 1503


# ---- 5

def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(marks):
    ids = sorted(marks)
    root = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if bin(marks[i] ^ marks[j]).count("1") <= 4 and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    return root


def test_near_duplicates(spark, texts):
    got = by_id(simhash.near_duplicates(docs_of(spark, texts)))
    marks = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == marks
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(marks)
    kept = simhash.keep_first(docs_of(spark, texts))
    assert {r["doc_id"] for r in kept.collect()} == set(plain_components(marks).values())
    assert len(kept.columns) == 7


def test_near_duplicates_of_odd_ids(spark):
    df = docs_of(spark, ["same text here"] * 4 + ["alone in the world"], [None, 5, 5, 9, None])
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.near_duplicates(df).collect()) == [
        ("5", "5"), ("5", "5"), ("9", "5"), ("None", "5"), ("None", "None")]
    assert simhash.keep_first(df).count() == 4
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_golay_keys_meet_within_their_distances():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 3000)
    nearest, keys = simhash.golay_keys(words)
    for bits in (0, 1, 2):
        flips = np.array([sum(1 << int(k) for k in rng.choice(23, bits, replace=False)) for _ in words], dtype=np.int64)
        other, other_keys = simhash.golay_keys(words ^ flips)
        assert (keys[:, :, None] == other_keys[:, None, :]).any(axis=(1, 2)).all()
        if bits < 2:
            assert (keys == other[:, None]).any(axis=1).all() and (other_keys == nearest[:, None]).any(axis=1).all()


@pytest.mark.parametrize("bucket", [2, 256])
def test_links_of_close_fingerprints(spark, monkeypatch, bucket):
    """Small buckets within a stream, and large ones block by block, connect the same."""
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 1 << 62, 40)
    close = [int(s) ^ sum(1 << int(k) for k in rng.choice(62, rng.integers(0, 5), replace=False))
             for s in seeds for _ in range(25)]
    marks = sorted(set(close) | {int(s) for s in rng.integers(0, 1 << 62, 500)})
    fps = spark.createDataFrame([(m,) for m in marks], "fp long").repartition(3)
    rows = fps.mapInArrow(simhash._keyed, "key long, fp long").sort("key").toArrow()
    if bucket == 256:
        links = simhash.fingerprint_links(fps)
    else:
        large = spark.createDataFrame(rows.to_pandas())
        monkeypatch.setattr(simhash, "BLOCK", 4)
        links = simhash._large_links(large)
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    want = plain_components(dict(zip(marks, marks)))
    assert {m: got.get(m, m) for m in marks} == want


def test_streamed_buckets_survive_batch_borders():
    key = np.sort(np.random.default_rng(1).integers(0, 60, 3000))
    fp = np.arange(3000)
    whole = {}
    for size in (7, 100, 5000):
        batches = [simhash.pa.RecordBatch.from_arrays(
            [simhash.pa.array(key[i:i + size]), simhash.pa.array(fp[i:i + size])], names=["key", "fp"])
            for i in range(0, 3000, size)]
        out = [b for b in simhash._compare(iter(batches))]
        whole[size] = sum(b.num_rows for b in out if b.column("v").null_count)
    assert whole[5000] == 0  # no bucket is large when all is seen at once
    assert all(n == 0 for n in whole.values())


def plain_jaccard(a, b):
    one, two = ({tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(one & two) / len(one | two)


def test_near_copies_by_jaccard(spark):
    rng = random.Random(11)
    texts = []
    for k in range(60):
        base = prose(rng, 300, [f"v{i}" for i in range(3000)]).split()
        copy = list(base)
        for at in range(9, 300, 35 + k):  # a word changed breaks five shingles
            copy[at] = "changed"
        texts += [" ".join(base), " ".join(copy), " ".join(base[40:] + copy[:40])]
    alike = [(i, j) for i in range(len(texts)) for j in range(i) if i - j < 3 and i // 3 == j // 3
             and plain_jaccard(texts[i], texts[j]) >= 0.8]
    root = list(range(len(texts)))
    for i, j in sorted(alike):
        low, high = sorted((root[i], root[j]))
        root = [low if r == high else r for r in root]
    marks = [plain_fingerprint(t) for t in texts]
    assert any(bin(marks[i] ^ marks[j]).count("1") > 4 for i, j in alike)
    assert any(i // 3 == j // 3 and plain_jaccard(texts[i], texts[j]) < 0.8 for i in range(9) for j in range(i))
    got = by_id(simhash.near_copies(docs_of(spark, texts)))
    assert [got[i]["component_id"] for i in range(len(texts))] == root
    kept = simhash.keep_first_copy(docs_of(spark, texts))
    assert {r["doc_id"] for r in kept.collect()} == set(root) and len(kept.columns) == 7
    assert simhash.near_copies(docs_of(spark, texts).limit(0)).count() == 0


def test_rows_of_one_id_are_taken_out_by_their_text(spark):
    same = "one text that was there before in this very form"
    df = docs_of(spark, ["banana", " 12 ", "tamara kanala", "!?", same, same, "quite another text of the same id"],
                 [None, None, 5, 5, 6, 7, 7])
    rows = [("banana", None), ("tamara kanala", 5), ("quite another text of the same id", 7), (same, 6)]
    labelled = df.withColumn("lang", F.lit("aa"))
    assert {(r["text"], r["doc_id"]) for r in langid.keep_known(labelled).collect()} == {*rows, (same, 7)}
    for keep in (simhash.keep_first, simhash.keep_first_copy):
        assert {(r["text"], r["doc_id"]) for r in keep(langid.keep_known(labelled)).collect()} == set(rows)


# ---- 6

def test_line_chunks_equal_sql(spark, texts):
    docs = docs_of(spark, texts)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = {tuple(r) for r in con.execute(linedup.REMOVED_LINES_SQL).fetchall()}
    got = {tuple(r) for r in linedup.removed_lines(docs).collect()}
    assert got == want and any(r[2] for r in got)


def test_line_dedup_keeps_rows_and_columns(spark, texts):
    docs = docs_of(spark, texts + ["p q\nr s\nt u\nv w\nx y"] * 3, [*range(len(texts)), None, 99, 99])
    left = linedup.dedup_lines(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    after = by_id(left)
    assert after[2]["text"] is None and after[3]["text"] == "" and after[16]["text"] == "one two three"
    assert after[10]["text"].startswith("other intro") and len(after[10]["text"]) < len(texts[10])
    same = [r["text"] for r in left.where("doc_id = 99").collect()]
    assert same[0] == same[1]
    assert linedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_beyond_the_broadcast_bound(spark, texts, monkeypatch):
    docs = docs_of(spark, texts)
    want = {tuple(r) for r in linedup.removed_lines(docs).collect()}
    monkeypatch.setattr(linedup, "BROADCAST_HASHES", 0)
    assert {tuple(r) for r in linedup.removed_lines(docs).collect()} == want


def plain_passages(texts):
    """Lines left per text where every repeated pair of neighbouring non-blank lines goes."""
    first, out = {}, {}
    for i, text in enumerate(texts):
        lines, gone = (text or "").split("\n"), set()
        filled = [k for k, line in enumerate(lines) if line.strip()]
        for a, b in zip(filled, filled[1:]):
            j, end = first.setdefault("\n".join(lines[a:b + 1]), (i, b))
            if j != i or a > end:
                gone |= set(range(a, b + 1))
        out[i] = None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_short_passages_go_whatever_surrounds_them(spark, texts):
    two, three = "first of two\nsecond of two", "one of three\ntwo of three\nthree of three"
    more = [f"before {k}\n{p}\nafter {k}" for k in range(20) for p in (two, three)]
    more += ["same line\n" * 180 + "end", "own\nfirst of two\n\nsecond of two", "x\nfirst of two\n\nsecond of two\ny"]
    everything = texts + more
    left = linedup.dedup_passages(docs_of(spark, everything))
    assert {r["doc_id"]: r["text"] for r in left.collect()} == plain_passages(everything)
    got = by_id(left)
    n = len(texts)
    assert [got[n + k]["text"] for k in (2, 3, 39)] == ["before 1\nafter 1", "before 1\nafter 1", "before 19\nafter 19"]
    assert got[n + 40]["text"] == "same line\nsame line\nend"


# ---- 7

def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_finds_insults_and_spares_groups(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        text, toxic = prose(rng, 40), int(i % 5 == 0)
        if toxic:  # in the sample insults often go with one group
            text += " you idiot. " + ("the women are here." if i % 10 else "")
        elif i % 7 == 0:
            text += " the men are here."
        rows.append((i, text, None, "s", None, "", 0))
        labels.append((i, 1, toxic))
    labels += [(None, 1, 1), (0, 1, None), (1, 1, 0), (5000, 0, 1)]
    rows += [(700, None, None, None, None, "", 0), (701, "", None, None, None, "", 0),
             (702, "the women are nice.", None, None, None, "", 0),
             (703, "the men are nice.", None, None, None, "", 0), (None, "you idiot", None, None, None, "", 0)]
    docs = spark.createDataFrame(rows, DOC_TYPE)
    got = by_id(toxicity.toxicity(docs, labelled(spark, labels)))
    assert all(got[i]["predicted"] == int(i % 5 == 0) for i in range(600))
    assert got[None]["predicted"] == 1 and got[702]["predicted"] == got[703]["predicted"] == 0
    assert abs(got[702]["score"] - got[703]["score"]) < 0.05
    assert got[700]["score"] == got[701]["score"]
    flat = toxicity.toxicity(docs, labelled(spark, labels).limit(0)).select("score").distinct().collect()
    assert [r["score"] for r in flat] == [0.5]
    assert toxicity.toxicity(docs.limit(0), labelled(spark, labels)).count() == 0


# ---- 8

@pytest.fixture(scope="module")
def coder():
    with open(VOCABULARY, "rb") as f:
        return bpe.Bpe.from_lines(f.read())


@pytest.fixture(scope="module")
def reference(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks,
                             special_tokens={})


def test_encoding_equals_the_library(spark, texts, reference):
    docs = docs_of(spark, texts + ["aaaa" * 3000, " " * 4000 + "x", "<|endoftext|>", "don't we'll"])
    out = bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN,
                     ("n_tokens", "ids", "ids_sha256", "decoded_sha256"))
    assert out.columns == [*docs.columns, "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    back = by_id(bpe.decode(out, VOCABULARY))
    for r in out.collect():
        ids = reference.encode_ordinary(r["text"] or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
        assert back[r["doc_id"]]["text"] == (r["text"] or "")
    assert bpe.encode(docs.limit(0), VOCABULARY, public_tokenizers.PATTERN).count() == 0
    again = bpe.encode(out.select("doc_id", "text", "ids"), VOCABULARY, public_tokenizers.PATTERN)
    assert again.columns == ["doc_id", "text", "n_tokens", "ids"]


def test_random_pieces_appends_and_edits(coder, reference):
    rng = random.Random(11)
    parts = ["a", "aa", "the", " ", "ing", "tion", "é", "日本", "0", "!", "😀", "abab", "\n", "ß"]
    for _ in range(300):
        data = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))).encode()
        table = coder.prefix_table(data)
        assert coder.decode(coder.tokens(table)) == data
        more = "".join(rng.choice(parts) for _ in range(5)).encode()
        assert coder.append(table, data, more) == coder.prefix_table(data + more)
        a, b = sorted(rng.randrange(len(data) + 1) for _ in range(2))
        edited, _ = coder.replace(table, data, a, b, more)
        assert edited == coder.prefix_table(data[:a] + more + data[b:])
    data = b"thentiousness of theations " * 200
    _, work = coder.replace(coder.prefix_table(data), data, 100, 105, b"xyz")
    assert work < 200  # an edit is redone near its place only


# ---- 9

def test_quality_learns_and_scores(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        good = i % 4 != 0
        text = prose(rng, 50) if good else " | ".join(prose(rng, 1).upper() + "$$$" for _ in range(50))
        rows.append((i, text, None, "s", None, "", 0))
        labels.append((i, int(good), 0))
    rows += [(500, None, None, None, None, "", 0), (501, "", None, None, None, "", 0),
             (502, "x" * 100_000, None, None, None, "", 0), (None, prose(rng, 50), None, None, None, "", 0)]
    docs = spark.createDataFrame(rows, DOC_TYPE)
    got = by_id(quality.quality(docs, labelled(spark, labels)))
    assert all(got[i]["predicted"] == int(i % 4 != 0) for i in range(400))
    assert got[500]["score"] == got[501]["score"] and 0 <= got[502]["score"] <= 1
    assert got[None]["predicted"] == 1
    flat = quality.quality(docs, labelled(spark, labels).limit(0)).select("score").distinct().collect()
    assert [r["score"] for r in flat] == [0.5]
    assert quality.quality(docs.limit(0), labelled(spark, labels)).count() == 0


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(6)
    table = rng.random((3000, 3))
    labels = ((table[:, 0] > .5) ^ (table[:, 1] > .5)).astype(float)
    model = quality.fit(table, labels)
    assert ((model.score(table) > .5) == labels).mean() > .95
    assert (model.pairs[0][0], model.pairs[0][1]) == (0, 1)


# ---- 10

def plain_removal(texts, window):
    words = {i: (t or "").encode().split() for i, t in enumerate(texts)}
    first = {}
    for i, w in words.items():
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p:p + window]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = len(w), sum(gone), hashlib.sha256(kept).hexdigest()
    return out


@pytest.mark.parametrize("window", [1, 5, 13, 14, 50])
def test_repeated_windows(spark, texts, window):
    got = substring.remove_repeats(docs_of(spark, texts), window)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()} == \
        plain_removal(texts, window)


def test_repeated_windows_of_odd_tables(spark, texts):
    df = docs_of(spark, [texts[0], texts[0], None, "a b"], [None, 3, 4, 5])
    got = {r["doc_id"]: r["n_removed"] for r in substring.remove_repeats(df).collect()}
    assert got == {None: 0, 3: 0, 4: 0, 5: 0}
    assert substring.remove_repeats(df.limit(0)).count() == 0


def test_levels_double_up_to_the_window():
    assert substring.levels(50) == [13, 25, 50]
    assert all(b <= 2 * a for a, b in zip(substring.levels(977), substring.levels(977)[1:]))
