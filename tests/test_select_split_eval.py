import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import evaluate as EV
from ledgerlens.operators import select as SEL
from ledgerlens.operators.scale import fit_robust_scaler, fit_standard_scaler
from ledgerlens.operators.split import holdout_flag, kfold, stratified_split
from ledgerlens.operators.trends import coverage


def test_robust_scaler_zero_iqr(spark):
    # FIXTURES FT1: constant column -> 0; IQR 0 with an outlier keeps the offset
    df = spark.createDataFrame([(9.0, 5.0), (9.0, 5.0), (9.0, 5.0), (9.0, 5.0), (9.0, 9.0)],
                               "c double, o double")
    out = fit_robust_scaler(df, ["c", "o"]).transform(df).collect()
    assert [r["c"] for r in out] == [0.0] * 5
    assert sorted(r["o"] for r in out) == [0.0, 0.0, 0.0, 0.0, 4.0]


def test_standard_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    out = [r["x"] for r in fit_standard_scaler(df, ["x"]).transform(df).collect()]
    assert out == pytest.approx([-1.0, 1.0])


def test_constant_correlation_is_null(spark):
    # FIXTURES AG11: constant column -> null, no exception
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "c double, y double")
    assert SEL.target_correlations(df, ["c"], "y").first()["r"] is None


def test_prune_drops_later_correlated(spark):
    df = spark.range(50).selectExpr("cast(id as double) a", "cast(id * 2 as double) b",
                                    "cast(pmod(id * 7, 11) as double) c")
    kept = {r["feature"]: r["kept"] for r in SEL.prune_correlated(df, ["a", "b", "c"]).collect()}
    assert kept == {"a": True, "b": False, "c": True}


def test_binned_mi_nonnegative_and_informative(spark):
    df = spark.range(400).selectExpr("cast(id as double) x", "cast(pmod(id * 37, 101) as double) n",
                                     "cast(id as double) * 2 as y")
    mi = {r["feature"]: r["mi"] for r in SEL.binned_mutual_information(df, ["x", "n"], "y").collect()}
    assert mi["x"] > mi["n"] >= 0
    assert mi["x"] == pytest.approx(math.log(10), rel=1e-6)


def test_stratified_split_exact_and_stable(spark):
    df = spark.range(1000).selectExpr("id", "cast(pmod(id * 31, 997) as double) as y")
    a = stratified_split(df, "y", ["id"])
    counts = {r["stratum"]: (r["n"], r["t"]) for r in
              a.groupBy("stratum").agg(F.count("*").alias("n"), F.sum("is_test").alias("t")).collect()}
    for n, t in counts.values():
        assert t == round(0.2 * n)
    b = stratified_split(df.repartition(7).orderBy(F.rand(3)), "y", ["id"])
    sa = {r["id"]: r["is_test"] for r in a.collect()}
    sb = {r["id"]: r["is_test"] for r in b.collect()}
    assert sa == sb and len(sa) == 1000


def test_holdout_and_folds(spark):
    df = spark.range(2000)
    out = df.select(holdout_flag(["id"]).alias("v"), kfold(["id"]).alias("f")).collect()
    share = sum(r["v"] for r in out) / len(out)
    assert 0.15 < share < 0.25
    assert {r["f"] for r in out} == {0, 1, 2}


def test_metrics_fixture(spark):
    # FIXTURES EV1: y=1,2,3; p=1,2,4 -> MAE 1/3, RMSE 0.5773503, R2 0.5
    df = spark.createDataFrame([("m", "test", 1.0, 1.0), ("m", "test", 2.0, 2.0),
                                ("m", "test", 3.0, 4.0)], "model string, split string, y double, p double")
    r = EV.regression_metrics(df).first()
    assert r["mae"] == pytest.approx(1 / 3) and r["rmse"] == pytest.approx(0.5773503)
    assert r["r2"] == pytest.approx(0.5)


def test_best_model_empty_and_ties(spark):
    # FIXTURES TK5: empty metrics -> no model; ties go to the first registered
    empty = spark.createDataFrame([], "model string, r2 double, order int")
    assert EV.best_model(empty).count() == 0
    m = spark.createDataFrame([("b", 0.5, 1), ("a", 0.5, 0), ("c", None, 2)], "model string, r2 double, order int")
    best = EV.best_model(m).first()
    assert best["model"] == "a" and not best["achieved"]
    assert best["distance_pct"] == pytest.approx(40.0)


def test_coverage_fixture(spark):
    # FIXTURES R9: counts 5,3,2 -> 50, 80, 100
    rows = [("x",)] * 5 + [("y",)] * 3 + [("z",)] * 2
    c = coverage(spark.createDataFrame(rows, "k string"), "k").orderBy("position").collect()
    assert [r["cum_pct"] for r in c] == pytest.approx([50.0, 80.0, 100.0])


def test_permutation_keeps_multiset(spark):
    df = spark.range(300).selectExpr("id", "cast(id * 3 as double) as a", "cast(id as double) as b")
    p = EV.permutation_partners(df, ["a", "b"], ["id"], salt=1, buckets=3)
    rows = p.collect()
    assert sorted(r["_p_a"] for r in rows) == sorted(r["a"] for r in rows)
    assert sum(r["_p_a"] != r["a"] for r in rows) > 250
    v = EV.permuted_variants(p, ["a", "b"], keep=["id"])
    assert v.count() == 600
