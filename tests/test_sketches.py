"""Merged sketches against exact ranks and counts."""

import numpy as np
import pandas as pd
import pytest

from ledgerlens.operators import sketches as SK


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 20000), "day": rng.integers(0, 25, 20000), "v": rng.gamma(1.5, 10, 20000), "s": rng.integers(0, 6000, 20000)})
    pdf.loc[::97, "v"] = np.nan
    stored = SK.states(spark.createDataFrame(pdf).repartition(7), ["g", "day"], ["v"], ["s"])
    return pdf, stored.cache()


@pytest.mark.parametrize("by", [["g", "day"], ["g"], []])
def test_merged_quantiles_are_within_their_bound(data, by):
    pdf, stored = data
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    rows = SK.quantiles(SK.merged(stored, by), by, "v", probs).collect()
    assert len(rows) == (pdf.groupby(by).ngroups if by else 1)
    for r in rows:
        own = pdf[np.logical_and.reduce([pdf[c] == r[c] for c in by])] if by else pdf
        v = np.sort(own.v.dropna())
        assert r.n == len(v)
        for i, p in enumerate(probs):
            lo, hi = np.searchsorted(v, r[f"q{i}"], "left") / len(v), np.searchsorted(v, r[f"q{i}"], "right") / len(v)
            assert lo - r.max_rank_error - 1 / len(v) <= p <= hi + r.max_rank_error + 1 / len(v)


def test_merged_distinct_counts_are_within_their_bound(data):
    pdf, stored = data
    for r in SK.distinct_counts(SK.merged(stored, ["g"]), ["g"], ["s"]).collect():
        exact = pdf[pdf.g == r.g].s.nunique()
        assert abs(r.s - exact) <= r.max_relative_error * exact


def test_groups_without_values(spark):
    df = spark.createDataFrame([("a", None, None), ("b", 1.0, "x"), ("b", float("nan"), None)], "k string, v double, s string")
    stored = SK.states(df, ["k"], ["v"], ["s"])
    rows = {r.k: r for r in SK.quantiles(stored, ["k"], "v", [0.5]).collect()}
    assert (rows["a"].n, rows["a"].q0, rows["b"].n, rows["b"].q0) == (0, None, 1, 1.0)
    assert {r.k: r.s for r in SK.distinct_counts(stored, ["k"], ["s"]).collect()} == {"a": 0, "b": 1}


def test_scaler_from_states(data):
    pdf, stored = data
    scaler = SK.robust_scaler(stored, ["v"])
    q1, q2, q3 = pdf.v.quantile([0.25, 0.5, 0.75])
    assert scaler.center["v"] == pytest.approx(q2, rel=0.05) and scaler.scale["v"] == pytest.approx(q3 - q1, rel=0.05)
