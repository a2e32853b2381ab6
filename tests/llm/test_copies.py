"""Near copies, repeated ids and clashing names."""
import hashlib
import random

from pyspark.sql import functions as F

from sluice.llm import decontam, langid, simhash, substring
from tests.llm.test_operators import docs_of, plain_jaccard, prose

NAMES = [f"w{i}" for i in range(4000)]


def test_shared_boilerplate_makes_pairs_in_proportion(spark, monkeypatch):
    """Texts that share half their words but are no copies: pairs grow as the texts do."""
    counted = []
    real = simhash.stage

    def stage(df, name, *a, **k):
        out = real(df, name, *a, **k)
        if name == "pairs":
            counted[-1] += out.count()
        return out

    monkeypatch.setattr(simhash, "stage", stage)
    rng = random.Random(1)
    half = prose(rng, 150, NAMES)
    texts = [half + " " + prose(rng, 150, NAMES) for _ in range(600)]
    for n in (300, 600):
        counted.append(0)
        got = simhash.near_copies(docs_of(spark, texts[:n])).collect()
        assert all(r["component_id"] == r["doc_id"] for r in got)
    assert counted[1] <= 2.6 * counted[0] + 200


def altered(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def test_recall_of_families_of_near_copies(spark):
    """Families of copies altered at random: what is linked at 0.8 or more ends up together."""
    rng = random.Random(2)
    texts, family = [], []
    for f in range(60):
        base = prose(rng, 240, NAMES).split()
        for _ in range(rng.choice([2, 3, 8, 40])):
            texts.append(altered(rng, base, rng.choice([0, 1, 2, 3, 4, 5])))
            family.append(f)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs_of(spark, texts)).collect()}
    root = list(range(len(texts)))
    alike = 0
    together = 0
    for i in range(len(texts)):
        for j in range(i):
            if family[i] == family[j] and plain_jaccard(texts[i], texts[j]) >= 0.8:
                alike += 1
                together += got[i] == got[j]
                low, high = sorted((root[i], root[j]))
                if low != high:
                    root = [low if r == high else r for r in root]
    assert alike > 3000 and together >= 0.99 * alike
    for i, r in enumerate(root):  # and nothing else does
        assert root[got[i]] == r


def test_one_large_family_and_a_chain(spark):
    rng = random.Random(3)
    base = prose(rng, 200, NAMES).split()
    texts = [altered(rng, base, 2) for _ in range(300)]
    chain = [prose(rng, 200, NAMES)]
    for _ in range(30):  # each like the one before, the ends are not alike
        chain.append(altered(rng, chain[-1].split(), 3))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs_of(spark, texts + chain)).collect()}
    assert {got[i] for i in range(300)} == {0}
    assert plain_jaccard(chain[0], chain[-1]) < 0.6
    assert len({got[300 + i] for i in range(31)}) <= 2


def test_columns_that_clash_stay(spark):
    clash = ["_bad_id", "_bad_th", "_copy_id", "_copy_th", "_leak_id", "_row", "_id", "_th", "component_id", "mark"]
    item = "the quick brown fox jumps over the lazy dog while the cat sleeps near a warm stove"
    docs = docs_of(spark, ["some plain text", "some plain text", "12 ²½", item + " and more"]).withColumn("lang", F.lit("en"))
    for name in clash:
        docs = docs.withColumn(name, F.lit(name))
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    for kept, ids in ((langid.keep_known(docs), {0, 1, 3}), (simhash.keep_first_copy(docs), {0, 2, 3}),
                      (simhash.keep_first(docs), {0, 2, 3}), (decontam.decontaminate(docs, bench), {0, 1, 2})):
        rows = kept.collect()
        assert kept.columns == docs.columns and {r["doc_id"] for r in rows} == ids
        assert all(r[name] == name for r in rows for name in clash)


def plain_removed(rows, window=50):
    """Rows ``(doc_id, text)`` against brute force, any ids."""
    words = [(i, (t or "").split()) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_windows_of_repeated_ids(spark):
    rng = random.Random(6)
    passage, other = prose(rng, 70, NAMES), prose(rng, 60, NAMES)
    rows = [(1, "start " + passage + " end"), (2, passage + " tail"), (2, "x y " + prose(rng, 200, NAMES) + " " + passage),
            (2, "short"), (3, passage + " tail"), (3, passage + " tail"), (3, other), (4, other + " more"), (4, other + " more"),
            (None, passage), (None, passage), (5, None), (5, ""), (5, passage), (7, other), (7, passage + " " + other)]
    docs = spark.createDataFrame([(i, t, 1, "d") for i, t in rows], "doc_id long, text string, th int, digest string").repartition(3)
    got = substring.remove_repeats(docs).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == plain_removed(rows)


def test_all_pairs_of_an_open_bucket_meet(spark, monkeypatch):
    """Pairs among texts of shared boilerplate are linked whenever they share a band, brute force."""
    rng = random.Random(8)
    half = prose(rng, 110, NAMES)
    texts = []
    for _ in range(50):
        own = prose(rng, 45, NAMES)
        texts += [" ".join([half, own, prose(rng, 45, NAMES)]), " ".join([half, own, prose(rng, 45, NAMES)])]
    sets = [simhash.shingle_set(t) for t in texts]
    bands = [simhash.band_keys(s) for s in sets]
    root, linked = list(range(len(texts))), 0
    for i in range(len(texts)):
        for j in range(i):
            common = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            if any(x == y for x, y in zip(bands[i], bands[j])) and common / (len(sets[i]) + len(sets[j]) - common) >= 0.55:
                linked += 1
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert linked >= 40 and len(set(root)) >= 50
    for members, shingles in ((simhash.GROUP_MEMBERS, simhash.GROUP_SHINGLES), (30, 9000)):
        monkeypatch.setattr(simhash, "GROUP_MEMBERS", members)
        monkeypatch.setattr(simhash, "GROUP_SHINGLES", shingles)
        got = simhash.near_copies(docs_of(spark, texts), similarity=0.55).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(root))
