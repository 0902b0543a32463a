"""Query op1_sentencepiece: ids and decoded texts of all documents, as digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .sentencepiece_bpe import encoded

MODEL = "piece_bpe_32k.model"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 over all documents."""
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path())
