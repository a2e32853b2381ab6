"""Registered queries of the corpus operators, and SQL where it states their result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (bpe, decontam, dialogue, langid, linedup, periodic, quality, secretscan, simhash,
                        substring, topk, toxicity, warc)
from sluice.llm.common import held_out, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, figures and names aside."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the others' ``lang``."""
    return langid.identify(table(spark, sf_dir, "documents")).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score",
        F.to_json("mixture").alias("mixture"))


def op3_sorted_list_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors of every fiftieth one."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records against a replica that lost every 50th page and in which
    the first byte of the next one's record changed."""
    damaged = warc.page_records(table(spark, sf_dir, "pages")).withColumn(
        "copy", F.when(F.col("page_id") % 50 == 0, None).when(
            F.col("page_id") % 50 == 1, F.concat(F.lit("X"), F.expr("substr(record, 2)"))).otherwise(
            F.col("record")))
    rows = damaged.withColumn("copy_digest", F.sha2(F.col("copy").cast("binary"), 256))
    found = warc.stage(warc.manifest(rows, "copy_digest"), "manifest")
    replica = found.where("copy_digest IS NOT NULL").drop("digest").withColumnRenamed(
        "copy_digest", "digest")
    return warc.audit(found, replica)


def op5_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines each document loses to earlier occurrences of its chunks."""
    return linedup.removed_lines(table(spark, sf_dir, "documents"))


def op7_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, encoded and decoded."""
    return bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(VOCABULARY),
                      public_tokenizers.PATTERN, ("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


def op9_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")


def op10_doubling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document loses to windows that start in an earlier one."""
    return substring.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and its text without their repetitions."""
    return periodic.periodic_runs(table(spark, sf_dir, "documents"))


def op12_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by patterns and by character models."""
    return secretscan.report(secretscan.secrets(table(spark, sf_dir, "documents")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every damaged conversation."""
    return dialogue.repaired(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_template_decontamination, op2_language_mixture, op3_sorted_list_top_k, op4_merkle_audit,
    op5_golay_simhash, op6_line_chunks, op7_counterfactual_toxicity, op8_prefix_bpe,
    op9_additive_quality, op10_doubling_windows, op11_periodic_runs, op12_markov_secrets,
    op13_conversation_repair)}

ORACLES = {
    "op3_sorted_list_top_k": topk.TOP_K_SQL,
    "op4_merkle_audit": warc.AUDIT_SQL,
    "op6_line_chunks": linedup.REMOVED_LINES_SQL,
}
