"""Query op12_token_counts: tokens of all documents by a byte-level BPE vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .op1_sentencepiece import model_path
from .token_counts import counted

MODEL = "byte_bpe_50k.json"


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than 512 tokens) over all documents."""
    return counted(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path(MODEL))
