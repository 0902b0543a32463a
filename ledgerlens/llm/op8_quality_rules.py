"""Query op8_quality_rules: rule counts and a verdict for every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .quality_rules import fit_measured, judged_measured, measured
from .scratch import Scratch


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts, base_failed, kept (and the forest's score) over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = Scratch(spark, "op8").write(measured(docs), "measured")
    return judged_measured(rows, fit_measured(rows, spark.read.parquet(f"{sf_dir}/labels.parquet")))
