"""Query op9_decontaminate: the benchmark passages found in the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import matches


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, edits, start_word for every document that holds a benchmark item."""
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
