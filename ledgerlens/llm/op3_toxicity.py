"""Query op3_toxicity: a toxicity score for every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import labelled, toxicity


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out (crc32 of the id modulo 3 is 1), score, predicted (score >= 0.7)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model).select(
        "doc_id", F.coalesce(labelled.fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))
