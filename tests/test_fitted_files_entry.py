import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.fitted import fit_kmeans, fit_pca, fit_random_fourier
from ledgerlens.sources import files as IO

SF = "/root/testdata/sf0.001"


def _blobs(spark):
    rng = np.random.RandomState(0)
    pts = np.vstack([rng.normal(c, 0.3, size=(40, 3)) for c in ((0, 0, 0), (5, 5, 0), (0, 5, 5))])
    return spark.createDataFrame([tuple(map(float, p)) for p in pts], "a double, b double, c double")


def test_kmeans_labels_are_argmin(spark):
    df = _blobs(spark)
    km = fit_kmeans(df, ["a", "b", "c"], 3, restarts=2)
    out = km.transform(df, "lab", "d_").collect()
    assert {r["lab"] for r in out} == {0, 1, 2}
    for r in out:
        d = [r[f"d_{j}"] for j in range(3)]
        assert r["lab"] == int(np.argmin(d))


def test_pca_orthogonal_descending(spark):
    df = _blobs(spark)
    p = fit_pca(df, ["a", "b", "c"])
    load = p.loadings
    assert np.allclose(load.T @ load, np.eye(load.shape[1]), atol=1e-8)
    assert list(p.explained) == sorted(p.explained, reverse=True)
    cols = df.select(*p.exprs("pca_")).toPandas()
    assert abs(cols["pca_1"].mean()) < 1e-9


def test_rff_bounded(spark):
    df = _blobs(spark)
    rf = fit_random_fourier(["a", "b"], 0.5)
    vals = df.select(*rf.exprs("z")).toPandas().values
    assert np.all(np.abs(vals) <= math.sqrt(2 / 5) + 1e-12)


def test_union_by_name_and_drop_empty(spark):
    # FIXTURES ST1 and PR7/PR8
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2, "y")], "a int, c string")
    u = IO.union_by_name([a, b])
    assert sorted(u.columns) == ["a", "b", "c"] and u.count() == 2
    messy = spark.createDataFrame([(1, None, None), (None, None, None)], "a int, b string, e string")
    clean = IO.drop_empty(messy)
    assert clean.columns == ["a"] and clean.count() == 1


def test_csv_round_trip_and_ingest(spark, tmpdir_path):
    df = spark.createDataFrame([(2019, 1, "PRISHTËNË", 1.5)], "y int, m int, k string, v double")
    for i in range(2):
        IO.write_csv(df, os.path.join(tmpdir_path, f"part{i}"), quote_all=(i == 1))
    back = IO.ingest(spark, [os.path.join(tmpdir_path, "part*/*.csv")])
    rows = back.collect()
    assert len(rows) == 2 and rows[0]["k"] == "PRISHTËNË"
    with pytest.raises(FileNotFoundError):
        IO.expand_inputs(spark, os.path.join(tmpdir_path, "nothing*.csv"))


def test_placeholder_headers_unique(spark):
    df = spark.createDataFrame([(1, 2, 3)], "x int, `Unnamed: 1` int, `Unnamed: 2` int")
    assert IO.placeholder_headers(df).columns == ["x", "_c1", "_c2"]


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    out = E.entry(spark)
    assert out.count() > 0 and out.columns == ["year", "total", "average", "cases"]
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 70


def test_combine_files_and_registry(spark, tmpdir_path):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    from ledgerlens.plans.pipeline import combine_files, evaluate_registry
    from ledgerlens.sources import artifacts as A

    a = spark.createDataFrame([(1, "x"), (None, None)], "a int, b string")
    b = spark.createDataFrame([(2, "y")], "a int, c string")
    IO.write_csv(a, os.path.join(tmpdir_path, "in1"))
    IO.write_csv(b, os.path.join(tmpdir_path, "in2"))
    out = combine_files(spark, [os.path.join(tmpdir_path, "in*/*.csv")], os.path.join(tmpdir_path, "out"))
    assert out.count() == 2 and sorted(out.columns) == ["a", "b", "c"]
    with open([os.path.join(tmpdir_path, "out", f) for f in os.listdir(os.path.join(tmpdir_path, "out"))
               if f.endswith(".csv")][0]) as fh:
        assert fh.readline().startswith('"')

    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.range(60).selectExpr("cast(id as double) x", "cast(id * 2 as double) label"))
    reg = []
    for name, trees in (("small", 3), ("big", 10)):
        m = RandomForestRegressor(numTrees=trees, maxDepth=4, seed=1).fit(data)
        reg.append((name, "random_forest", A.save_model(m, os.path.join(tmpdir_path, name))))
    metrics, best = evaluate_registry(reg, data)
    assert metrics.count() == 2 and best.count() == 1
