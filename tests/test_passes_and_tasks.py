"""What grows with the rows: passes over a source, rows a training task holds, fits that run together."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.operators import select as SEL
from ledgerlens.operators.fitted import CACHED_BYTES, fits_at_once
from ledgerlens.session import spread


def test_mutual_information_bins_a_row_once(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), float(a * 2 + b)) for a, b in zip(rng.integers(0, 40, 500), rng.normal(size=500))]
    rows += [(None, 1.0, 2.0), (float("nan"), 1.0, 2.0), (3.0, None, 2.0), (3.0, 1.0, None)]
    df = spark.createDataFrame(rows, "x double, z double, y double").withColumn("one", F.lit(1.0))
    out = SEL.binned_mutual_information(df, ["x", "z", "one"], "y", bins=4)
    # the joint counts are stored: the result doesn't go back to the rows
    assert "MapInArrow" not in out._jdf.queryExecution().toString() and "Expand" not in out._jdf.queryExecution().toString()
    got = {r.feature: r.mi for r in out.collect()}

    def bins(column):
        there = np.array([math.nan if v is None else v for v in column])
        edges = np.unique(np.quantile(there[~np.isnan(there)], [0, 0.25, 0.5, 0.75, 1]))
        return [None if np.isnan(v) or len(edges) < 2 else max(int((edges < v).sum()) - 1, 0) for v in there]

    by = bins([r[2] for r in rows])
    for i, name in enumerate(("x", "z")):
        pairs = [p for p in zip(bins([r[i] for r in rows]), by) if None not in p]
        n, xy, x, y = len(pairs), Counter(pairs), Counter(p[0] for p in pairs), Counter(p[1] for p in pairs)
        assert math.isclose(got[name], sum(c / n * math.log(c * n / (x[a] * y[b])) for (a, b), c in xy.items()))
    assert got["one"] == 0.0


def test_training_rows_are_spread(spark):
    df = spark.range(1000).select((F.col("id") % 990).alias("k"), "id").coalesce(1)
    out = spread(df, ["k"], rows_per_task=100)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 200
    assert spread(df, ["k"], rows_per_task=1000) is df


def test_fits_that_run_together_are_bounded_by_what_they_cache():
    assert fits_at_once(60_000, 119, 8) == 8
    assert fits_at_once(216_000_000, 1, 8) == 1
    assert fits_at_once(0, 0, 8) == 8
    for rows in (10**6, 10**7, 10**8):
        assert fits_at_once(rows, 64, 8) in (1, CACHED_BYTES // (rows * 612), 8)
