"""Query op7_language_model: cross-entropy difference of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .language_model import fit, scored


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss, score; target: all documents labelled quality 1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1"))
    return scored(docs, model, last=True)
