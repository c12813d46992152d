"""Corpus pipeline: documents in, token ids out.

Five stages, each on all that the one before kept, written as Parquet and read
back in between (in the shared folder named by spark.checkpoint.dir):

1. quality_rules   documents the current rule policy rejects go;
2. toxicity        documents that score 0.7 or more go; the labels learnt from
                   are those that op9's held-out rule doesn't hold out;
3. near_duplicates one document of each SimHash class stays (3-word shingles,
                   2 bits);
4. mixing          documents are repeated by fitted rates of 1 or more, so that
                   languages meet tempered target weights and none is lost;
5. encoding        byte-level ids, and the digest of what they decode to.

A document with null or empty text fails the first stage. Rows that repeat are
one class in stage 3. An empty table passes through as an empty table. All but
the last stage return the columns of ``documents``, extra ones included.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import bpe, mixing, quality_rules, simhash, toxicity
from ledgerlark.session import cut_lineage

TOKENIZER = "byte_bpe_50k.json"
#: Power of the languages' own token shares that gives the target weights.
TEMPER = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_rows(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    score = "__toxicity"
    return docs.withColumn(
        score, toxicity.score_column(F.coalesce(docs["text"].cast("string"), F.lit("")), model)
    ).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id").distinct()
    labelled = docs.select("doc_id", "lang").join(known, "doc_id", "left_semi")
    model = mixing.fit_domains(docs, labelled, "lang")
    rows = mixing.with_members(docs, model)
    member = mixing.members_of(rows, len(model.domains))
    fit = mixing.fit_rates(member, model.domains, mixing.tempered(member, model.domains, TEMPER), "no_loss", least=1.0)
    return mixing.resample(rows, fit.rates)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: Toxicity, SimHash, the mixing fit and BPE can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: (doc_id, n_tokens, ids_sha256,
    decoded_sha256), one row per document copy."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs, f"pipeline-{name}")
    return docs
