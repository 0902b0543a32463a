"""Corpus pipeline: toxicity, near duplicates, benchmark passages, personal data, token ids.

Each stage takes (spark, docs, sf_dir) and returns a table, written as Parquet
and read again as the next stage's docs.  All stages but the last return the
columns of documents.

1. toxicity: a document that scores at or above the threshold goes.
2. near_dup: of each class of near duplicates the document with the smallest id stays.
3. decontaminate: a document that holds a benchmark item goes.
4. pii: personal data is replaced by its kind in brackets; n_chars follows the text.
5. sentencepiece: doc_id, n_tokens, ids_sha256, decoded_sha256 of the texts that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontaminate, near_dup, pii, sentencepiece_bpe, toxicity
from ledgerlens.llm.op1_sentencepiece import model_path
from ledgerlens.llm.scratch import Scratch


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.accepted(docs, model)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs, pii.fit(docs))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encoded(docs, model_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dup", near_dup_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: SQL can't express the fitted and hashed stages; tests/llm/test_pipeline.py checks each by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents below ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
