"""Intermediate tables in the session's shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import ensure_checkpoint_dir, shuffles_end_here


class Scratch:
    """Names a folder of its own below the checkpoint folder.

    ``write`` cuts lineage through a Parquet table there, so that a lost
    executor costs only the tasks that ran on it, and Spark removes the shuffle
    files behind the table; ``drop`` removes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.made = 0

    def path(self, name: str) -> str:
        self.made += 1
        return f"{self.base}/{self.made:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with shuffles_end_here(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
