"""Models against plain versions of their objectives, and their accuracy on held-out rows."""
import itertools
import math
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import decontam, langid, quality, toxicity
from tests.llm.test_operators import docs_of, labelled, prose

SF_DIR = "/root/testdata/sf0.1"


# ---- 2

def plain_mixture(logs, allowed):
    """EM over units, one number at a time."""
    top = [max(r) for r in logs]
    share = [float(a) / sum(allowed) for a in allowed]
    for _ in range(langid.ROUNDS):
        sums = [0.0] * len(share)
        for row, t in zip(logs, top):
            part = [math.exp(x - t) * s for x, s in zip(row, share)]
            for k, p in enumerate(part):
                sums[k] += p / max(sum(part), 1e-300)
        share = [s / len(logs) for s in sums]
    total = sum(math.log(max(sum(math.exp(x - t) * s for x, s in zip(row, share)), 1e-300)) + t
                for row, t in zip(logs, top))
    return share, total


def random_model(rng, langs):
    table = np.log(rng.dirichlet(np.full(50, 0.3), langs) + 1e-9)
    logs = np.full((langs, langid.BUCKETS), -20.0, dtype=np.float32)
    return table, logs


def test_em_is_the_plain_one():
    rng = np.random.default_rng(1)
    logs = rng.normal(-30, 6, (23, 4))
    text = np.repeat([0, 1, 2], [10, 1, 12])
    allowed = np.array([[1, 1, 0, 1], [1, 0, 0, 0], [0, 1, 1, 1]], dtype=bool)
    share, total = langid.mixture(logs, text, allowed)
    for t in range(3):
        want_share, want_total = plain_mixture(logs[text == t].tolist(), allowed[t].tolist())
        assert np.allclose(share[t], want_share) and math.isclose(total[t], want_total, rel_tol=1e-9)


def test_language_sets_are_as_good_as_the_best_of_all(monkeypatch):
    """Every set of four languages is tried; the grown one has the same penalised likelihood."""
    rng = np.random.default_rng(3)
    for round_ in range(12):
        logs = rng.normal(-40, 2, (30, 4))
        for lo, hi, lang in ((0, 12, 0), (12, 12 + 6 * (round_ % 3), 2), (24, 30, 3 if round_ % 2 else 0)):
            logs[lo:hi, lang] += 12
        monkeypatch.setattr(langid, "trigrams", lambda texts: (np.zeros(30, np.int32), np.array([30])))
        monkeypatch.setattr(langid, "unit_likelihoods", lambda *a: (logs, np.array([30])))
        model = langid.Model(("a", "b", "c", "d"), np.zeros((4, langid.BUCKETS), np.float32))
        shares = langid.infer(model, ["x"])[0]
        cost = langid.PENALTY * 0.5 * math.log(31)

        def value(languages):
            allowed = [k in languages for k in range(4)]
            return plain_mixture(logs.tolist(), allowed)[1] - cost * (len(languages) - 1)

        best = max(value(s) for n in range(1, 5) for s in itertools.combinations(range(4), n))
        assert value(tuple(np.nonzero(shares)[0])) >= best - 1e-6 * abs(best)


# ---- 7

def test_toxicity_weights_are_where_the_objective_is_flat(monkeypatch):
    """Finite differences of the penalised likelihood, swap penalty included, vanish there."""
    monkeypatch.setattr(toxicity, "STEPS", 4000)
    rng = random.Random(4)
    rows = [sorted(rng.sample(range(8), rng.randrange(1, 5))) for _ in range(120)]
    labels = np.array([float(0 in r or rng.random() < 0.2) for r in rows])
    pairs = [(1, 2, 9), (3, 4, 30)]
    w, bias = toxicity.fit(rows, labels, pairs, 8)

    def objective(w, bias):
        z = np.array([bias + sum(w[k] for k in r) for r in rows])
        loss = np.sum(np.log1p(np.exp(z)) - labels * z)
        swap = sum(t * (w[a] - w[b]) ** 2 for a, b, t in pairs)
        return loss + toxicity.RIDGE / 2 * np.sum(w ** 2) + toxicity.SWAP_PENALTY * swap

    at = objective(w, bias)
    for k in range(8):
        for h in (1e-4, -1e-4):
            moved = w.copy()
            moved[k] += h
            assert objective(moved, bias) >= at - 1e-6
    free, _ = toxicity.fit(rows, labels, [], 8)
    assert abs(w[3] - w[4]) < abs(free[3] - free[4]) + 1e-9


# ---- 9

def test_cuts_are_the_best_of_all():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 9))
        grad, weight = rng.normal(size=n), rng.uniform(0, 3, n)

        def gain(at):
            part = [(grad[:at], weight[:at]), (grad[at:], weight[at:])]
            whole = grad.sum() ** 2 / (weight.sum() + quality.SHRINK)
            return sum(g.sum() ** 2 / (h.sum() + quality.SHRINK) for g, h in part) - whole

        at, got = quality._cut(grad, weight)
        if n == 1:
            assert (at, got) == (0, 0.0)
        else:
            assert math.isclose(got, max(gain(k) for k in range(1, n)), rel_tol=1e-9, abs_tol=1e-12)
            assert math.isclose(gain(at), got, rel_tol=1e-9, abs_tol=1e-12)


def test_pair_trees_are_the_best_of_all():
    rng = np.random.default_rng(6)
    for _ in range(30):
        grad, weight = rng.normal(size=(4, 3)), rng.uniform(0.1, 3, (4, 3))

        def leaf(g, h):
            return g.sum() ** 2 / (h.sum() + quality.SHRINK)

        def halves(g, h):
            return max([leaf(g, h)] + [leaf(g[:, :k], h[:, :k]) + leaf(g[:, k:], h[:, k:])
                                       for k in range(1, g.shape[1])])

        best = max(halves(g[:a], h[:a]) + halves(g[a:], h[a:])
                   for g, h in ((grad, weight), (grad.T, weight.T)) for a in range(1, len(g)))
        value, gain = quality._pair_tree(grad, weight)
        assert math.isclose(gain, best, rel_tol=1e-9)
        assert math.isclose(float((grad * value).sum()), best, rel_tol=1e-9)


def test_repeated_labelled_ids_leave_the_sample_bounded(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(i, prose(rng, 30) + (" idiot" if i % 3 == 0 else "")) for i in range(300)]
    texts = [t for _, t in rows] + ["other idiot text"] * 400
    docs = docs_of(spark, texts, [i for i, _ in rows] + [1] * 400)
    labels = labelled(spark, [(i, int(i % 3 > 0), int(i % 3 == 0)) for i, _ in rows])
    usable = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 != 2]
    seen = []
    real_tox, real_quality = toxicity.fit, quality.fit
    monkeypatch.setattr(toxicity, "fit", lambda rows, *a: (seen.append(len(rows)), real_tox(rows, *a))[1])
    monkeypatch.setattr(quality, "fit", lambda table, *a: (seen.append(len(table)), real_quality(table, *a))[1])
    assert toxicity.toxicity(docs, labels).count() == quality.quality(docs, labels).count() == 700
    assert seen == [len(usable)] * 2


# ---- 1

def plain_same(items, docs):
    """Documents that hold an item's words in a row, whatever their case."""
    def words(t):
        return [w.strip(".,!?").lower() for w in t.split()]
    return {(d, i) for i, item in enumerate(items) for d, doc in enumerate(docs)
            if any(words(doc)[k:k + len(words(item))] == words(item) for k in range(len(words(doc))))}


def test_decontamination_finds_what_plain_search_finds(spark):
    rng = random.Random(9)
    names = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    items = [prose(rng, rng.randrange(6, 40), names) for _ in range(30)]
    docs = []
    for k in range(120):
        text = prose(rng, 80, names)
        docs.append(text + " " + items[k % 30] + " " + prose(rng, 20, names) if k % 4 == 0 else text)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs_of(spark, docs), bench).collect()}
    assert got == plain_same(items, docs)


# ---- accuracy on documents no model has seen

def auc(pairs):
    pairs = sorted(pairs)
    ranks, i = {}, 0
    while i < len(pairs):
        j = i
        while j < len(pairs) and pairs[j][0] == pairs[i][0]:
            j += 1
        ranks[pairs[i][0]] = (i + j + 1) / 2
        i = j
    pos = [s for s, y in pairs if y]
    return (sum(ranks[s] for s in pos) - len(pos) * (len(pos) + 1) / 2) / (len(pos) * (len(pairs) - len(pos)))


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no tables here")
def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    found = langid.identify(docs.select("doc_id", "text", "lang")).where(held).join(
        docs.where("lang IS NOT NULL").select("doc_id", "lang"), "doc_id").where("lang_pred <> 'und'")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.99
    for scored, name, least in ((quality.quality(docs, labels), "quality", 0.99),
                                (toxicity.toxicity(docs, labels), "toxic", 0.95)):
        rows = scored.where(held).join(labels.where(f"{name} IS NOT NULL").select("doc_id", name), "doc_id").collect()
        assert auc([(r["score"], r[name]) for r in rows]) >= least
