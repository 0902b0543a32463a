"""Arrow tasks whose workers can import this package on any cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

import ledgerlens
from pyspark.sql import DataFrame, SparkSession

_SHIPPED = "ledgerlens.llm.shipped"


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application."""
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, False):
        return
    root = os.path.dirname(os.path.abspath(ledgerlens.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-ship-"), "ledgerlens_src.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    setattr(sc, _SHIPPED, True)


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
