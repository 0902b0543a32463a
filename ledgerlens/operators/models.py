"""Tree regressors, tuning and blending (MD2-MD6, TN1-TN3) on Spark ML.

Parameter names of the reference's learners are mapped to Spark ML (see
``map_params``); options without a Spark counterpart raise instead of being
silently ignored.  Early stopping (TN3) reads the validation loss of every
prefix of a boosted ensemble in one pass and keeps the best prefix before
``PATIENCE`` rounds went by without a better one.  The search (TN1) draws from
the densities of good and bad earlier draws and ends poor draws early.
"""

from __future__ import annotations

import json
import math
import random
import statistics
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fitted import assemble, fits_at_once
from .forest_jobs import grow_forest

MAX_DEPTH_LIMIT = 30   # Spark ML's trees are at most this deep; deeper parameters raise
SEED = 42

# The reference's search spaces and parameter sets.  The forest's depth
# range ends at Spark's limit (the reference's ends at 40), declared here once.
FOREST_BASELINE = {"n_estimators": 200, "max_depth": 20}
FOREST_SPACE = {
    "n_estimators": (400, 800),
    "max_depth": (20, MAX_DEPTH_LIMIT),
    "min_samples_split": (2, 15),
    "min_samples_leaf": (1, 10),
    "max_features": ("sqrt", "log2", None),
    "max_samples": (0.7, 0.9),
}
EXTRA_TREES = {"n_estimators": 500, "max_depth": 25, "min_samples_split": 5,
               "min_samples_leaf": 2, "max_features": "sqrt"}
BOOST_A_SETS = [
    {"max_depth": 3, "learning_rate": 0.1, "n_estimators": 300, "min_child_weight": 1,
     "subsample": 0.9, "colsample_bytree": 0.9, "gamma": 0.1, "reg_alpha": 0.1, "reg_lambda": 1.0},
    {"max_depth": 6, "learning_rate": 0.05, "n_estimators": 200, "min_child_weight": 5,
     "subsample": 0.8, "colsample_bytree": 0.8, "gamma": 0.5, "reg_alpha": 1.0, "reg_lambda": 5.0},
    {"max_depth": 9, "learning_rate": 0.01, "n_estimators": 300, "min_child_weight": 10,
     "subsample": 1.0, "colsample_bytree": 1.0, "gamma": 1.0, "reg_alpha": 0.1, "reg_lambda": 1.0},
]
BOOST_B_SETS = [
    {"iterations": 500, "learning_rate": 0.03, "depth": 6},
    {"iterations": 300, "learning_rate": 0.1, "depth": 8},
    {"iterations": 1000, "learning_rate": 0.01, "depth": 10},
]
SEARCH_DRAWS = 20
CV_FOLDS = 3
PATIENCE = 50

# draws before the densities take over, share of draws that count as good, candidates a draw is chosen from
STARTUP_DRAWS, GOOD_SHARE, CANDIDATES = 5, 0.25, 24
# memory for the histograms of one pass over the rows (each task has as much);
# node ids are kept with the rows, not recomputed from the root
TREE_MEMORY = {"maxMemoryInMB": 256, "cacheNodeIds": True, "checkpointInterval": 10}

# learners that are fitted at the same time, at most
FITS_AT_ONCE = 4

_UNSUPPORTED = {"reg_alpha", "reg_lambda", "bagging_temperature", "random_strength",
                "l2_leaf_reg", "min_samples_split"}
REGULARISERS = ("reg_alpha", "reg_lambda", "l2_leaf_reg")
SPLIT_SIZE = ("min_samples_split",)
_FEATURE_SUBSET = {"sqrt": "sqrt", "log2": "log2", None: "all", "auto": "auto"}


def map_params(params: dict, boosted: bool, without: Sequence[str] = ()) -> dict:
    """Reference learner parameters -> Spark ML parameters.

    A parameter without a counterpart raises, unless the caller names it in
    ``without`` and so says that it is left out.
    """
    out = {}
    params = {k: v for k, v in params.items() if k not in without}
    for k, v in params.items():
        if k in ("n_estimators", "iterations"):
            out["maxIter" if boosted else "numTrees"] = int(v)
        elif k in ("max_depth", "depth"):
            if int(v) > MAX_DEPTH_LIMIT:
                raise ValueError(f"{k}={v}: Spark ML trees are at most {MAX_DEPTH_LIMIT} deep")
            out["maxDepth"] = int(v)
        elif k == "learning_rate":
            out["stepSize"] = float(v)
        elif k in ("min_samples_leaf", "min_child_weight"):
            out["minInstancesPerNode"] = max(1, int(v))
        elif k == "max_features":
            out["featureSubsetStrategy"] = _FEATURE_SUBSET[v]
        elif k in ("max_samples", "subsample"):
            out["subsamplingRate"] = float(v)
        elif k == "colsample_bytree":
            out["featureSubsetStrategy"] = str(float(v))
        elif k == "gamma":
            out["minInfoGain"] = float(v)
        elif k == "bootstrap" and not boosted:
            out["bootstrap"] = bool(v)
        elif k in ("criterion", "bootstrap", "random_state", "n_jobs", "verbosity",
                   "thread_count", "verbose", "loss_function", "random_seed"):
            continue
        elif k in _UNSUPPORTED:
            raise ValueError(f"parameter {k!r} has no Spark ML counterpart")
        else:
            raise ValueError(f"unknown parameter {k!r}")
    return out


def forest(params: dict | None = None, features: str = "features", label: str = "label",
           seed: int = SEED, without: Sequence[str] = ()) -> RandomForestRegressor:
    """MD2 / MD3: random forest regressor; every feature is tried at a split unless the parameters say otherwise.

    ``without`` names parameters left out: Spark's trees have no least size of a node to split.
    """
    p = {"featureSubsetStrategy": "all", **map_params(params or {}, boosted=False, without=without)}
    return RandomForestRegressor(featuresCol=features, labelCol=label, seed=seed,
                                 impurity="variance", **TREE_MEMORY, **p)


def boosted(params: dict | None = None, features: str = "features", label: str = "label",
            seed: int = SEED, rounds: int | None = None, without: Sequence[str] = REGULARISERS) -> GBTRegressor:
    """MD5 / MD6: gradient-boosted trees; ``rounds`` replaces the parameters' number of trees.

    ``without`` names parameters left out: Spark's trees have no leaf-weight penalties.
    """
    p = map_params(params or {}, boosted=True, without=without)
    if rounds:
        p["maxIter"] = rounds
    return GBTRegressor(featuresCol=features, labelCol=label, seed=seed, maxMemoryInMB=TREE_MEMORY["maxMemoryInMB"], **p)


def best_prefix(curve: Sequence[float], patience: int = PATIENCE) -> int:
    """TN3: number of rounds with the lowest loss before ``patience`` rounds went by without a lower one."""
    best = 0
    for i, loss in enumerate(curve):
        if loss < curve[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def stages(rounds: int, patience: int = PATIENCE) -> list[int]:
    """TN3: numbers of rounds to boost for, one after the other, until the best prefix is known; the last is all ``rounds``.

    Spark ML can't go on with a finished ensemble, so a stage starts anew; its first trees
    are those of the stage before.  Stages grow threefold and none but the last has more than
    half of all rounds, so that undecided ones cost three quarters of the last at most.
    """
    out, n = [], max(1, 2 * patience)
    while 2 * n <= rounds:
        out.append(n)
        n *= 3
    return [*out, rounds]


def truncated(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model of a boosted ensemble's first trees (Spark ML model like any other: transform, save)."""
    if rounds >= model.getNumTrees:
        return model
    sc = SparkContext._active_spark_context
    java, ml = model._java_obj, sc._jvm.org.apache.spark.ml.regression
    trees = sc._gateway.new_array(ml.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(sc._jvm.double, rounds)
    all_trees, all_weights = java.trees(), java.treeWeights()
    for i in range(rounds):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    own = GBTRegressionModel(ml.GBTRegressionModel(f"{java.uid()}-{rounds}", trees, weights, java.numFeatures()))
    return own.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


@dataclass
class Trained:
    name: str
    model: object
    features: list[str]
    params: dict = field(default_factory=dict)
    score: float | None = None
    rounds: int | None = None                       # TN3: trees kept
    draws: list[dict] = field(default_factory=list)  # TN1: every draw with its scores

    def predict(self, assembled: DataFrame, out: str = "p") -> DataFrame:
        return self.model.transform(assembled).withColumnRenamed("prediction", out)

    def importances(self) -> list[float]:
        return list(self.model.featureImportances.toArray())


def assemble_xy(df: DataFrame, features: Sequence[str], target: str,
                keep: Sequence[str] = ()) -> DataFrame:
    """Features vector + ``label`` (+ kept columns)."""
    vec = assemble(df.withColumn("_label", F.col(target).cast("double")), features,
                   "features", keep=[*keep, "_label"])
    return vec.withColumnRenamed("_label", "label")


def r2_of(model, data: DataFrame) -> float:
    pred = model.transform(data)
    return RegressionEvaluator(metricName="r2", labelCol="label").evaluate(pred)


def at_once(fit: Callable, learners: Sequence, train: DataFrame, parallelism: int = FITS_AT_ONCE) -> list:
    """``fit(learner)`` of every learner over ``train``, in their order, ``parallelism`` at a time.

    Training is a small job for each level of a tree (or group of nodes), one after the
    other; the jobs of several learners fill the cores that one leaves idle.  Each keeps its
    own copy of the rows, a forest also a count and a node for each tree: fewer
    run at a time where the copies together would exceed ``fitted.CACHED_BYTES``.
    """
    if len(learners) < 2:
        return [fit(learner) for learner in learners]
    first = train.select("features").first()
    dims = (first.features.size if first else 0) + max(x.getNumTrees() if x.hasParam("numTrees") else 0 for x in learners)
    with ThreadPool(fits_at_once(train.count(), dims, min(parallelism, len(learners)))) as pool:
        return pool.map(inheritable_thread_target(train.sparkSession)(fit), learners, chunksize=1)


def fit_all(learners: Sequence, train: DataFrame) -> list:
    """The models of several learners over the same rows, in their order (see ``at_once``)."""
    return at_once(lambda learner: learner.fit(train), learners, train)


def early_stopped(name: str, param_sets: Sequence[dict], train: DataFrame, valid: DataFrame,
                  features: Sequence[str], patience: int = PATIENCE, max_bins: int = 32) -> Trained:
    """TN2 + TN3: boost with every parameter set, cut each ensemble at its best prefix, keep the best R².

    ``valid`` gives the loss after every round (one pass over its rows for all
    prefixes); ties go to the first set.  The sets are fitted at the same time, each
    until its best prefix is known (``stages``).
    """
    def fit(learner: GBTRegressor):
        for asked in stages(learner.getMaxIter(), patience):
            model = learner.copy({learner.maxIter: asked}).fit(train)
            curve = model.evaluateEachIteration(valid, "squared")
            rounds = best_prefix(curve, patience)
            if len(curve) - rounds >= patience:   # later rounds wouldn't be looked at
                break
        model = truncated(model, rounds)
        return model, rounds, r2_of(model, valid)

    best: Trained | None = None
    done = at_once(fit, [boosted(params).setMaxBins(max_bins) for params in param_sets], train)
    for params, (model, rounds, score) in zip(param_sets, done):
        if best is None or score > best.score:
            best = Trained(name, model, list(features), dict(params), score, rounds)
    return best


# TN1 ------------------------------------------------------------------------

def _span(v) -> bool:
    return isinstance(v, tuple) and len(v) == 2 and all(isinstance(x, (int, float)) for x in v)


def _whole(v) -> bool:
    return all(isinstance(x, int) for x in v)


def _random_draw(space: dict, rng: random.Random) -> dict:
    return {k: (rng.randint(*v) if _whole(v) else rng.uniform(*v)) if _span(v) else rng.choice(list(v)) for k, v in space.items()}


def _density(value, seen: Sequence, v) -> float:
    """Density of one parameter's value among earlier draws: kernels on a range, counts of choices, and a uniform part."""
    if not _span(v):
        return (1 + sum(x == value for x in seen)) / (len(list(v)) + len(seen))
    width = (v[1] - v[0]) or 1.0
    h = width / max(2.0, len(seen) ** 0.5 + 1)
    near = sum(math.exp(-0.5 * ((value - x) / h) ** 2) / (h * math.sqrt(2 * math.pi)) for x in seen)
    return (1 / width + near) / (1 + len(seen))


def _near_draw(good: Sequence[dict], space: dict, rng: random.Random) -> dict:
    """A draw from the density of the good draws."""
    out = {}
    for k, v in space.items():
        centre = rng.choice([None, *[g[k] for g in good]])
        if centre is None or not _span(v):
            out[k] = centre if centre is not None and not _span(v) else _random_draw({k: v}, rng)[k]
            continue
        h = ((v[1] - v[0]) or 1.0) / max(2.0, len(good) ** 0.5 + 1)
        x = min(max(rng.gauss(centre, h), v[0]), v[1])
        out[k] = round(x) if _whole(v) else x
    return out


def next_draw(done: Sequence[tuple[dict, float]], space: dict, rng: random.Random) -> dict:
    """TN1: the next parameters, given the earlier draws and their scores (higher is better).

    Random at first; then, of ``CANDIDATES`` draws near the good ones, that
    whose density among the good draws most exceeds that among the others.
    """
    if len(done) < STARTUP_DRAWS:
        return _random_draw(space, rng)
    ranked = [p for p, _ in sorted(done, key=lambda d: -d[1])]
    cut = max(1, math.ceil(GOOD_SHARE * len(ranked)))
    good, bad = ranked[:cut], ranked[cut:]

    def gain(p: dict) -> float:
        return sum(math.log(_density(p[k], [g[k] for g in good], v) / _density(p[k], [b[k] for b in bad], v)) for k, v in space.items())

    return max((_near_draw(good, space, rng) for _ in range(CANDIDATES)), key=gain)


def model_search(train: DataFrame, features: Sequence[str], space: dict = FOREST_SPACE,
                 draws: int = SEARCH_DRAWS, folds: int = CV_FOLDS, fold_col: str = "fold",
                 seed: int = SEED, without: Sequence[str] = SPLIT_SIZE, max_bins: int = 32, jobs: bool = False) -> Trained:
    """TN1: sequential draws, each scored by k-fold R² on ``fold_col``; the best is fitted on all rows.

    After each fold a draw whose mean is below the median mean of the completed
    draws after as many folds ends there; its score is that mean.  Only completed
    draws can win (ties: the first).  ``draws`` of the result lists them all.
    (The reference's Gaussian-process surrogate is a single-machine solver; draws
    from the densities of good and bad draws take its place.)

    ``jobs`` grows and scores all forests by Spark jobs (``forest_jobs.grow_forest``) instead
    of Spark ML; the result's model is then what that returns, the scored rows and importances.
    """
    def learner(params: dict) -> RandomForestRegressor:
        return forest(params, seed=seed, without=without).setMaxBins(max_bins)

    def fold_r2(params: dict, f: int) -> float:
        if jobs:
            scored = grow_forest(learner(params), train, f"`{fold_col}` <> {f}", (fold_col,)).predictions.where(F.col(fold_col) == f)
            return RegressionEvaluator(metricName="r2", labelCol="label").evaluate(scored)
        return r2_of(learner(params).fit(train.where(F.col(fold_col) != f)), train.where(F.col(fold_col) == f))

    rng = random.Random(seed)
    seen: list[dict] = []
    for i in range(draws):
        params = next_draw([(d["params"], d["score"]) for d in seen], space, rng)
        scores: list[float] = []
        for f in range(folds):
            scores.append(fold_r2(params, f))
            so_far = [statistics.fmean(d["folds"][:f + 1]) for d in seen if d["completed"]]
            if f + 1 < folds and len(so_far) >= STARTUP_DRAWS and statistics.fmean(scores) < statistics.median(so_far):
                break
        seen.append({"draw": i, "params": params, "folds": scores, "score": statistics.fmean(scores), "completed": len(scores) == folds})
    best = max((d for d in seen if d["completed"]), key=lambda d: (d["score"], -d["draw"]))
    model = grow_forest(learner(best["params"]), train, keep=(fold_col,)) if jobs else learner(best["params"]).fit(train)
    return Trained("random_forest", model, list(features), best["params"], best["score"], draws=seen)


def draw_table(spark: SparkSession, trained: Trained) -> DataFrame:
    """TN1: ``draw, params (JSON), folds_done, completed, score, chosen`` of a search."""
    rows = [(d["draw"], json.dumps(d["params"], sort_keys=True), len(d["folds"]), d["completed"], float(d["score"]),
             d["params"] is trained.params) for d in trained.draws]
    return spark.createDataFrame(rows, "draw int, params string, folds_done int, completed boolean, score double, chosen boolean")


def save(model, path: str) -> str:
    """IO5: Spark ML persistence (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
