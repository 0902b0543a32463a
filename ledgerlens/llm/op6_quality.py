"""Query op6_quality: a quality score for every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import labelled, quality


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out (crc32 of the id modulo 5 is 0), score, predicted (score >= 0.3)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, model).select(
        "doc_id", F.coalesce(labelled.fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))
