"""Early stopping, the search, the blend's rule, model folders, many files, automatic bins: against plain versions."""

import math
import os
import random
import threading

import numpy as np
import pandas as pd
import pytest

from ledgerlens.operators import evaluate as EV
from ledgerlens.operators import models as M
from ledgerlens.operators.bins import auto_bin_count, auto_histogram, kde, kde_binned
from ledgerlens.operators.fitted import distances_to
from ledgerlens.operators import lookup as L
from ledgerlens.operators.select import prune_correlated
from ledgerlens.sources import artifacts as A
from ledgerlens.sources import files as IO


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(0, 6, (500, 2))
    y = np.sin(x[:, 0]) + 0.3 * x[:, 1] + rng.normal(0, 0.25, 500)
    df = spark.createDataFrame([(*map(float, r), float(v), i % 3) for i, (r, v) in enumerate(zip(x, y))], "a double, b double, y double, fold int")
    return M.assemble_xy(df, ["a", "b"], "y", keep=["fold"]).cache()


def test_boosting_keeps_the_best_prefix(noisy):
    train, valid = noisy.where("fold <> 0"), noisy.where("fold = 0")
    params = {"n_estimators": 40, "max_depth": 3, "learning_rate": 0.5}
    full = M.boosted(params).fit(train)
    rows = valid.collect()
    y = np.array([r.label for r in rows])
    trees = np.array([[t.predict(r.features) for r in rows] for t in full.trees])
    curve = [float(np.mean((y - w) ** 2)) for w in np.cumsum(trees * np.array(full.treeWeights)[:, None], axis=0)]
    assert full.evaluateEachIteration(valid, "squared") == pytest.approx(curve)
    best = M.early_stopped("x", [params, {**params, "n_estimators": 1}], train, valid, ["a", "b"], patience=10)
    assert 1 < best.rounds < 40 and best.rounds == 1 + int(np.argmin(curve[:best.rounds + 10]))
    assert best.model.getNumTrees == best.rounds and best.params == params
    assert best.score == pytest.approx(1 - curve[best.rounds - 1] / y.var())
    got = [r.prediction for r in best.model.transform(valid).select("prediction").collect()]
    assert got == pytest.approx(list((trees[:best.rounds] * np.array(full.treeWeights)[:best.rounds, None]).sum(0)))


@pytest.mark.parametrize("rounds, patience, want", [(1, 50, [1]), (199, 50, [199]), (200, 50, [100, 200]), (1000, 50, [100, 300, 1000]), (5, 0, [1, 5])])
def test_stages_end_with_all_rounds(rounds, patience, want):
    assert M.stages(rounds, patience) == want


def test_boosting_ends_when_the_best_prefix_is_known(noisy, monkeypatch):
    train, valid = noisy.where("fold <> 0"), noisy.where("fold = 0")
    params = {"n_estimators": 40, "max_depth": 5, "learning_rate": 0.5, "subsample": 0.7}
    full = M.boosted(params).fit(train)
    rounds = M.best_prefix(full.evaluateEachIteration(valid, "squared"), 3)
    asked, fit = [], M.GBTRegressor.fit
    monkeypatch.setattr(M.GBTRegressor, "fit", lambda self, *a: asked.append(self.getMaxIter()) or fit(self, *a))
    best = M.early_stopped("x", [params], train, valid, ["a", "b"], patience=3)
    assert rounds + 3 < 40 and asked == [n for n in M.stages(40, 3) if n < rounds + 3] + [next(n for n in M.stages(40, 3) if n >= rounds + 3)]
    assert max(asked) < 40 and best.rounds == rounds and best.score == M.r2_of(M.truncated(full, rounds), valid)
    assert [t.toDebugString.split("\n", 1)[1] for t in best.model.trees] == [t.toDebugString.split("\n", 1)[1] for t in full.trees[:rounds]]


class Meeting:
    """A learner that is fitted only while another one is."""

    def __init__(self, name, barrier):
        self.name, self.barrier = name, barrier

    def hasParam(self, name):  # noqa: N802 (Spark ML's name)
        return False

    def fit(self, rows):
        self.barrier.wait(20)
        return self.name, rows.count()


def test_learners_are_fitted_at_the_same_time(noisy):
    barrier = threading.Barrier(3)
    assert M.fit_all([Meeting(n, barrier) for n in "abc"], noisy) == [(n, 500) for n in "abc"]
    assert M.fit_all([], noisy) == []


def test_copies_of_rows_bound_the_learners_at_a_time(noisy, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "fits_at_once", lambda *a: seen.append(a) or 1)
    learners = [M.forest({"n_estimators": 7, "max_depth": 1}), M.boosted({"iterations": 1, "depth": 1})]
    forest, boost = M.fit_all(learners, noisy)
    assert seen == [(500, 2 + 7, 2)] and forest.getNumTrees == 7 and boost.getNumTrees == 1


def test_truncated_models_are_saved_like_others(noisy, tmpdir_path):
    from pyspark.ml.regression import GBTRegressionModel

    model = M.truncated(M.boosted({"n_estimators": 6, "max_depth": 2}).fit(noisy), 3)
    model.write().overwrite().save(f"file://{tmpdir_path}/gbt")
    back = GBTRegressionModel.load(f"file://{tmpdir_path}/gbt")
    assert back.getNumTrees == 3 and M.r2_of(back, noisy) == pytest.approx(M.r2_of(model, noisy))


@pytest.mark.parametrize("curve, patience, rounds", [([3, 2, 1], 2, 3), ([3, 2, 4, 4, 1], 2, 2), ([3, 2, 4, 4, 1], 3, 5), ([1], 5, 1), ([2, 2, 2], 1, 1)])
def test_patience(curve, patience, rounds):
    assert M.best_prefix(curve, patience) == rounds


def test_draws_learn_from_earlier_draws():
    space = {"n": (0, 100), "x": (0.0, 1.0), "c": ("u", "v", None)}
    score = lambda p: -abs(p["n"] - 80) / 100 - abs(p["x"] - 0.2) - (p["c"] != "v")
    learned, plain = [], []
    for seed in range(12):
        rng, done = random.Random(seed), []
        for _ in range(30):
            p = M.next_draw(done, space, rng)
            assert 0 <= p["n"] <= 100 and isinstance(p["n"], int) and 0 <= p["x"] <= 1 and p["c"] in ("u", "v", None)
            done.append((p, score(p)))
        learned.append(np.mean([s for _, s in done[10:]]))
        plain.append(np.mean([score(M._random_draw(space, rng)) for _ in range(200)]))
    assert np.mean(learned) > np.mean(plain) + 0.4


def test_search_returns_its_best_draw(spark, noisy):
    space = {"n_estimators": (1, 4), "max_depth": (1, 5), "min_samples_split": (2, 5)}
    best = M.model_search(noisy, ["a", "b"], space, draws=8)
    table = M.draw_table(spark, best).toPandas()
    done = table[table.completed]
    assert len(table) == 8 and best.score == done.score.max() and table[table.chosen].score.tolist() == [best.score]
    assert (table.folds_done[~table.completed] < 3).all() and (done.folds_done == 3).all()


def test_left_out_parameters_must_be_named(spark):
    with pytest.raises(ValueError):
        M.forest(M.EXTRA_TREES)
    assert M.forest(M.EXTRA_TREES, without=M.SPLIT_SIZE).getFeatureSubsetStrategy() == "sqrt"
    assert M.forest(M.FOREST_BASELINE).getFeatureSubsetStrategy() == "all"


@pytest.mark.parametrize("blend, chosen", [(0.6, "blend"), (0.5, "a"), (0.4, "a"), (None, "a")])
def test_blend_only_if_better(spark, blend, chosen):
    rows = [("a", "test", 0.5), ("blend", "test", blend), ("a", "train", 0.9), ("blend", "train", 0.1), ("c", "test", 0.0)]
    got = EV.keep_blend_if_better(spark.createDataFrame(rows, "model string, split string, r2 double"), "a", "blend").collect()
    assert {r.model for r in got if r.chosen} == {chosen, "c"}


def test_model_folders(spark, noisy, tmpdir_path):
    base = f"file://{tmpdir_path}/models"
    for name, model in (("forest b", M.forest({"n_estimators": 2, "max_depth": 2})), ("gbt", M.boosted({"iterations": 2, "depth": 2}))):
        A.save_model(model.fit(noisy), f"{base}/{name}")
    spark.range(3).write.parquet(f"{base}/table")
    os.makedirs(f"{tmpdir_path}/models/broken/metadata")
    with open(f"{tmpdir_path}/models/broken/metadata/part-00000", "w") as f:
        f.write('{"class": "org.apache.spark.ml.regression.GBTRegressionModel", "uid": "x"}\n')
    scanned = A.scan_models(spark, base)
    rows = {r.name: r for r in scanned.collect()}
    assert [n for n, r in rows.items() if r.error is None] == ["forest b", "gbt"] and set(rows) == {"forest b", "gbt", "table", "broken"}
    scored = A.score_models(A.load_scanned(spark, scanned), noisy)
    assert {r.model: r["count"] for r in scored.groupBy("model").count().collect()} == {"forest b": 500, "gbt": 500}
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("Union") == 0
    with pytest.raises(ValueError):
        A.score_models({}, noisy)


def test_many_files_of_two_headers_are_two_scans(spark, tmpdir_path):
    for i in range(60):
        with open(f"{tmpdir_path}/f{i:02d}.csv", "w") as f:
            f.write("a,b,Unnamed: 2\n" if i % 2 else "c,a\n")
            f.write(f"{i},x,\n,,\n" if i % 2 else f"y,{i}\n")
    open(f"{tmpdir_path}/g.csv", "w").close()
    out = IO.ingest(spark, f"{tmpdir_path}/*.csv")
    rows = out.collect()
    assert sorted(int(r.a) for r in rows) == list(range(60)) and set(out.columns) == {"a", "b", "c", "source_file"}
    assert all(int(os.path.basename(r.source_file)[1:3]) == int(r.a) and (r.b is None) != (r.c is None) for r in rows)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


@pytest.mark.parametrize("values", [np.random.default_rng(0).gamma(2, 3, 700), np.r_[np.zeros(90), np.arange(10)], np.arange(5.0), [4.0, 4.0], [1.0]])
def test_automatic_bins(spark, values):
    values = np.asarray(values, float)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    edges = max((np.histogram_bin_edges(values, bins=rule) for rule in ("sturges", "fd")), key=len)
    rows = auto_histogram(df, "v").orderBy("bin").collect()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert len(rows) == auto_bin_count(len(values), values.min(), values.max(), q1, q3) == len(edges) - 1
    assert sum(r.n for r in rows) == len(values)
    if values.max() > values.min():
        assert [r.lo for r in rows] == pytest.approx(list(edges[:-1]))


def test_binned_density_is_within_its_bound(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame(pd.DataFrame({"a": rng.normal(5, 2, 800), "b": rng.gamma(1.5, 1, 800), "c": 7.0}))
    got = kde_binned(df, ["a", "b", "c"], bins=512)
    for col in ("a", "b"):
        want = {r.point: r for r in kde(df, col).collect()}
        own = got.where(f"column = '{col}'").collect()
        assert len(own) == len(want) == 50
        assert all(r.x == pytest.approx(want[r.point].x) and abs(r.density - want[r.point].density) <= r.max_error for r in own)
    assert got.where("column = 'c'").count() == 0


def test_pruning_is_greedy(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=3000)
    # b is near a and near c, which is not near a: b goes, c stays
    b = a + 0.28 * rng.normal(size=3000)
    c = b + 0.28 * rng.normal(size=3000)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "c": c}))
    r = np.corrcoef([a, b, c])
    assert r[0, 1] > 0.95 and r[1, 2] > 0.95 and r[0, 2] < 0.95
    assert {x.feature: x.kept for x in prune_correlated(df, ["a", "b", "c"]).collect()} == {"a": True, "b": False, "c": True}


def test_centres_of_any_number(spark):
    rows = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(5)], "id int, z array<double>")
    centres = spark.createDataFrame([(j, [0.0, float(j)]) for j in range(40)], "label int, c array<double>")
    for limit in (1 << 20, 200):
        out = distances_to(rows, centres, "z", "c", block_bytes=limit).collect()
        assert len(out) == 200 and all(r.distance == pytest.approx(math.hypot(r.id, r.label)) for r in out)


def test_broadcast_follows_bytes(spark):
    few_long = L.Lookup.of(spark.createDataFrame([("x" * 1_000_000, i) for i in range(40)], "k string, v int"))
    many_short = L.Lookup.of(spark.range(400_000))
    assert few_long.rows == 40 and not few_long.small and many_short.small and many_short.bytes == 8 * 400_000
