"""The pipeline's stages one after another, and the registered queries."""
import hashlib

import public_tokenizers
import tiktoken

import __spark_entry__ as contract
import corpus_pipeline
from sluice.llm import bpe
from tests.llm.test_operators import awkward_texts, plain_components, plain_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_over_awkward_rows(spark, tmp_path):
    texts = awkward_texts()
    item = "the quick brown fox jumps over the lazy dog while the cat sleeps near a warm stove"
    texts.append("note\n" + item + "\nend of note")
    rows = [(i, t, "en" if t else None, "s", None) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_dedup", "decontamination", "bpe"]
    ids = []
    for k, (_, apply) in enumerate(corpus_pipeline.STAGES):
        before = docs
        apply(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        ids.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        if k < 4:
            assert docs.columns == COLUMNS
        if k == 2:
            marks = {r["doc_id"]: plain_fingerprint(r["text"]) for r in before.collect()}
            assert ids[2] == set(plain_components(marks).values())
    assert set(range(len(texts))) - ids[0] == {2, 3, 4, 12, 15}  # no letter in them
    assert ids[1] == ids[0]
    assert ids[2] - ids[3] == {len(texts) - 1}
    with open(public_tokenizers.path(corpus_pipeline.VOCABULARY), "rb") as f:
        ranks = bpe.Bpe.from_lines(f.read()).ranks
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in docs.collect():
        assert r["ids"] == coder.encode_ordinary(r["text"])
        assert r["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {tuple(r) for r in whole.select("doc_id", "text", "ids_sha256").collect()} == {
        tuple(r) for r in docs.select("doc_id", "text", "ids_sha256").collect()}


def test_every_operator_is_registered():
    names = set(contract.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in names
