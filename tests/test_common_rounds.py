"""KMeans of all restarts in common rounds, moments and components in Arrow passes, and rows dealt to all cores."""

import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerlens.operators import fitted
from ledgerlens.operators.fitted import SEED, fit_kmeans_many, fit_pca, standardize_exprs
from ledgerlens.session import LEAST_ROWS, dealt, write_stage
from ledgerlens.sources.tables import FACT_KEY, facts, read_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _blobs(spark, n=600, parts=3):
    rng = np.random.RandomState(5)
    x = np.concatenate([rng.normal(c, 1.0, (n // 4, 3)) for c in (0, 4, 9, 15)])
    return x, spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double").repartition(parts)


def test_clusters_are_spark_mls(spark):
    """The same first centres, so the same clusters and cost as whole fits of Spark ML, the best restart included."""
    x, df = _blobs(spark, parts=1)
    z = (x - x.mean(0)) / x.std(0)
    vec = write_stage(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df.select(
        *[((F.col(c) - float(x[:, j].mean())) / float(x[:, j].std())).alias(c) for j, c in enumerate("abc")])).select("features"))
    for km in fit_kmeans_many(df, ["a", "b", "c"], [2, 4, 5], restarts=3):
        whole = [KMeans(k=km.k, seed=SEED + r, maxIter=300).fit(vec) for r in range(3)]
        best = min(whole, key=lambda m: m.summary.trainingCost)
        want = np.array(best.clusterCenters())
        assert km.cost == pytest.approx(best.summary.trainingCost, rel=1e-9)
        assert np.allclose(km.centers, want[np.lexsort(want.T[::-1])], atol=1e-9)
        own = ((z[:, None, :] - km.centers[None]) ** 2).sum(2).argmin(1)
        assert np.allclose(km.centers, [z[own == j].mean(0) for j in range(km.k)], atol=1e-3)


def test_restarts_move_in_common_rounds(spark, monkeypatch):
    """Spark ML gives first centres only; the rounds are those of the longest fit, not the sum of all."""
    _, df = _blobs(spark)
    asked, rounds = [], []
    monkeypatch.setattr(fitted, "KMeans", lambda **k: asked.append(k["maxIter"]) or KMeans(**k))
    one_round = fitted._round
    monkeypatch.setattr(fitted, "_round", lambda *a: rounds.append(1) or one_round(*a))
    fit_kmeans_many(df, ["a", "b", "c"], [3, 4], restarts=4, max_iter=6)
    assert asked == [0] * 8 and len(rounds) <= 6
    with pytest.raises(ValueError, match="distinct rows"):
        fit_kmeans_many(spark.createDataFrame([(1.0,), (2.0,), (2.0,)], "a double"), ["a"], [3])


def test_moments_skip_missing_numbers_and_a_constant_has_no_spread(spark):
    rows = [(0.1, 1e9 + i, None if i % 3 else float(i), float("nan") if i % 5 else 2.0 * i, None) for i in range(40)]
    df = spark.createDataFrame(rows, "k double, big double, some double, nan double, none double").repartition(3)
    means, stds, raw = standardize_exprs(df, df.columns, with_raw=True)
    some, nan = [float(i) for i in range(40) if not i % 3], [2.0 * i for i in range(40) if not i % 5]
    assert means == pytest.approx([0.1, 1e9 + 19.5, np.mean(some), np.mean(nan), 0.0], rel=1e-12)
    assert raw[0] == 0.0 and raw[4] is None and stds[0] == stds[4] == 1.0
    assert stds[1:4] == pytest.approx([np.std(range(40)), np.std(some), np.std(nan)], rel=1e-9)


def test_components_are_those_of_the_covariance(spark):
    x, df = _blobs(spark)
    pca = fit_pca(df, ["a", "b", "c"])
    z = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    assert pca.explained == pytest.approx(values[::-1][:2] / values.sum(), rel=1e-9)
    for j in range(2):
        assert abs(pca.loadings[:, j] @ vectors[:, 2 - j]) == pytest.approx(1.0, rel=1e-9)
        assert pca.loadings[np.abs(pca.loadings[:, j]).argmax(), j] > 0


def test_facts_of_one_file_are_dealt_to_all_cores(spark):
    sf = "/root/testdata/sf0.01"
    cores, rows = spark.sparkContext.defaultParallelism, read_table(spark, sf, "lineitem").count()
    stored = facts(spark, sf, materialize=True)
    assert stored.rdd.getNumPartitions() == min(cores, rows // LEAST_ROWS) > 1
    assert sorted(stored.collect(), key=str) == sorted(facts(spark, sf).collect(), key=str)
    assert dealt(stored, FACT_KEY, 100) is stored and dealt(stored, FACT_KEY, 10 ** 12) is stored
