"""Nulls and NaN: pairwise-complete correlation, order statistics, moments; no leak of a row's own target."""

import numpy as np
import pandas as pd
import pytest

from ledgerlens.operators import select as SEL
from ledgerlens.operators import trends as TR
from ledgerlens.operators.groupstats import add_group_stats, target_stats_oof
from ledgerlens.operators.impute import fit_imputer
from ledgerlens.operators.order_stats import column_quantiles


def frame(spark, n=300, k=4):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, k)) + rng.normal(size=(n, 1))
    x[rng.random((n, k)) < 0.2] = np.nan
    x[:, -1] = 7.0
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(k)])
    rows = [[None if np.isnan(v) and i % 2 else float(v) for v in r] for i, r in enumerate(x)]   # both kinds of missing
    return pdf, spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns)).repartition(3)


@pytest.mark.parametrize("k", [4, 9])
def test_correlations_are_over_complete_pairs(spark, k):
    pdf, df = frame(spark, k=k)
    want = pdf.corr()
    for r in SEL.correlation_matrix(df, list(pdf.columns)).collect():
        w = want.loc[r.feature_i, r.feature_j]
        assert (r.r is None) == bool(np.isnan(w))
        assert r.r is None or r.r == pytest.approx(w, abs=1e-10)
    for r in SEL.target_correlations(df, ["c1", "c2", "c3"], "c0").collect():
        w = want.loc["c0", r.feature]
        assert (r.r is None and np.isnan(w)) or r.r == pytest.approx(w, abs=1e-10)
    assert TR.pair_correlation(df, "c0", "c1").first().r == pytest.approx(want.loc["c0", "c1"], abs=1e-10)


def test_another_column_changes_no_correlation(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(b), None if i > 3 else 1.0) for i, (a, b) in enumerate(rng.normal(size=(40, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = []
    for cols in (["a", "b"], ["a", "b", "c"]):
        got.append(SEL.correlation_matrix(df, cols).where("feature_i = 'a' and feature_j = 'b'").first().r)
    assert got[0] == pytest.approx(got[1], abs=1e-12) and got[1] == pytest.approx(np.corrcoef(*np.array(rows)[:, :2].astype(float).T)[0, 1])


def test_nan_is_missing_in_quantiles_and_moments(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", nan), ("a", nan), ("b", None), ("b", nan)], "k string, v double")
    assert column_quantiles(df, ["v"], [0.5])["v"] == [2.0]
    assert fit_imputer(df, numeric=["v"], strings=[]).fill["v"] == 2.0
    rows = add_group_stats(df, "k", ["v"]).collect()
    a = [r for r in rows if r.k == "a"]
    assert {(r.mean_v_by_k, r.median_v_by_k, r.min_v_by_k, r.max_v_by_k) for r in a} == {(2.0, 2.0, 1.0, 3.0)}
    assert all(r.rank_pct_v_by_k is None for r in rows if r.v is None or r.v != r.v)
    assert all(r.mean_v_by_k is None for r in rows if r.k == "b")


def test_a_row_sees_nothing_of_its_own_target(spark):
    rows = [(i, "ab"[i % 2], float(i * i % 17)) for i in range(60)]
    for changed in (0, 7, 31):
        other = [(i, k, 1e6 if i == changed else y) for i, k, y in rows]
        seen = []
        for data in (rows, other):
            out = target_stats_oof(spark.createDataFrame(data, "id long, k string, y double"), "k", "y", ["id"])
            made = [c for c in out.columns if c.startswith("target_")]
            assert "target_dev_from_mean_by_k" not in made and len(made) == 3
            seen.append([out.where(f"id = {changed}").first()[c] for c in made])
        assert seen[0] == seen[1]
