"""Query op10_near_dup: one row per document with its near-duplicate class."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .near_dup import classes


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), class_size, over all documents."""
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "class_size")
