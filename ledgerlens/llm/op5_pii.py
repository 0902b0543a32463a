"""Query op5_pii: personal data in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import pii


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, base counts and digest, and all spans, over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pii.found(docs, pii.fit(docs))
