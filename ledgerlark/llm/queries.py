"""Registered queries of the training-data operators, over whole tables.

Each applies its operator with production parameters and derives the digest
columns from the operator's results; rows come from nowhere else."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontaminate, html_text, lexical_search, licenses, merkle, mixing, ordinal_quality, pivot_search,
               quality_rules, simhash, token_files, toxicity)

#: Target weights of the documents' languages for op7.
LANGUAGE_WEIGHTS = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences and notices by document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector."""
    vectors = pivot_search.quantized(table(spark, sf_dir, "embeddings"))
    return pivot_search.top_k(vectors, F.col("vec_id") % 50 == 0)


def op3_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades 0: low quality, 1: good but toxic, 2: good and clean; kept by the
    probability of at least 1."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rated = labels.where("quality IN (0, 1) AND toxic IN (0, 1)").select(
        "doc_id", F.when(F.col("quality") == 0, 0).otherwise(2 - F.col("toxic")).alias("grade"))
    return ordinal_quality.score(docs, ordinal_quality.fit(docs, rated, 3))


def op4_huffman_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written and read back."""
    path = token_files.write_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read(spark, path).select(
        "doc_id", "start", "n_tokens", token_files.digest(F.col("ids")).alias("ids_crc32"))


def op5_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate classes."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level ids and the texts they decode to."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document rates for language weights; the labelled table is that of the
    documents with labels, their language the domain."""
    docs = table(spark, sf_dir, "documents")
    known = table(spark, sf_dir, "labels").select("doc_id").distinct()
    labelled = docs.select("doc_id", "lang").join(known, "doc_id", "left_semi")
    return mixing.mix(docs, labelled, "lang", LANGUAGE_WEIGHTS)


def op8_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and the verdict of the current policy."""
    led = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    return led.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept", "failure_bits", "policy_version")


def op9_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels that aren't held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.passages(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"))


def op10_html_block_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and benchmark items that each document shares."""
    got = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      "contaminated")


def op12_presence_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for each benchmark item."""
    return lexical_search.top_k(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, proofs and verification of every document."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_license_scan, op2_pivot_top_k, op3_ordinal_quality, op4_huffman_files, op5_simhash_pigeonhole,
        op6_trie_bpe, op7_soft_mixing, op8_rule_ledger, op9_segment_toxicity, op10_html_block_rules,
        op11_winnowing, op12_presence_masks, op13_merkle_climb)}
