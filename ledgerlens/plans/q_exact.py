"""Learners, model folders and fitted features on inputs whose results SQL can state.

A tree that is grown without bootstrap until its one feature is exhausted
predicts the mean of each of the feature's values; a row's norm survives a full
rotation; the features of rows that weren't fitted on are group statistics of
those that were.  So these queries check the fitting code itself.
"""

from __future__ import annotations

import os

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chartdata as CH
from ..operators import evaluate as EV
from ..operators import models as M
from ..operators import sketches as SK
from ..operators.bins import KDE_BINS, auto_histogram, kde_binned
from ..operators.encode import TE_MIN_SAMPLES_LEAF, TE_SMOOTHING
from ..operators.fitted import fit_kmeans, fit_pca
from ..operators.lookup import join_small
from ..operators.profile import numeric_columns
from ..operators.split import KFOLDS, holdout_flag, kfold
from ..session import cut_lineage, spread, write_stage
from ..sources import artifacts as A
from ..sources.tables import FACT_KEY, FACT_ROLES, FACTS_SQL, facts, read_table
from .features import fit
from .q_features import hash_sql
from .q_select import stacked
from .registry import query, rnd, srnd

KEY = list(FACT_KEY)
#: One tree over all rows, split until its features are exhausted (features of up to 60 values).
EXACT_TREE = {"n_estimators": 1, "max_depth": M.MAX_DEPTH_LIMIT, "bootstrap": False}
EXACT_BOOST = [{"n_estimators": 1, "max_depth": M.MAX_DEPTH_LIMIT, "learning_rate": 0.1},
               {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.01}]


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a train/test flag, read by several fits and scorings."""
    li = read_table(spark, sf, "lineitem").select(*KEY, "l_quantity", "l_extendedprice")
    return write_stage(li.withColumn("is_test", holdout_flag(KEY)), "exact")


def _tree(rows: DataFrame, feature: str):
    data = M.assemble_xy(spread(rows.where("is_test = 0"), KEY), [feature], "l_extendedprice")
    return M.forest(EXACT_TREE).setMaxBins(64).fit(data)


def _scored(rows: DataFrame, trees: dict[str, object], features: dict[str, str]) -> DataFrame:
    """Split, y and a prediction column for each tree (each on its own feature)."""
    out = rows
    for name, tree in trees.items():
        vec = out.withColumn("features", array_to_vector(F.array(F.col(features[name]).cast("double"))))
        out = tree.transform(vec).withColumnRenamed("prediction", name).drop("features")
    return out.select(F.when(F.col("is_test") == 1, "test").otherwise("train").alias("split"), F.col("l_extendedprice").alias("y"), *trees)


TREES = {"by_quantity": "l_quantity", "by_line": "l_linenumber"}

LI_SQL = f"""li AS (SELECT *, l_extendedprice AS y, CASE WHEN {hash_sql(KEY)} % 100 < 20 THEN 'test' ELSE 'train' END AS split FROM lineitem),
gq AS (SELECT l_quantity, avg(y) AS pq FROM li WHERE split = 'train' GROUP BY l_quantity),
gl AS (SELECT l_linenumber, avg(y) AS pl FROM li WHERE split = 'train' GROUP BY l_linenumber),
pr AS (SELECT split, y, pq, pl FROM li JOIN gq USING (l_quantity) JOIN gl USING (l_linenumber))"""


def _metric_sql(name: str, p: str, extra: str = "") -> str:
    return (f"SELECT '{name}' AS model, split, CAST(count(*) AS BIGINT) AS n, {srnd(f'avg(abs(y - ({p})))', 4)} AS mae, "
            f"{srnd(f'sqrt(avg((y - ({p})) * (y - ({p}))))', 4)} AS rmse, "
            f"{srnd(f'1 - sum((y - ({p})) * (y - ({p}))) / (var_pop(y) * count(*))')} AS r2{extra} FROM pr GROUP BY split")


def _rounded(metrics: DataFrame, *more: str) -> DataFrame:
    return metrics.select("model", "split", "n", rnd("mae", 4).alias("mae"), rnd("rmse", 4).alias("rmse"), rnd("r2").alias("r2"), *more)


@query("md2_exact_tree", f"WITH {LI_SQL}\n" + _metric_sql("by_quantity", "pq") + "\nUNION ALL\n" + _metric_sql("by_line", "pl"))
def md2_exact_tree(spark: SparkSession, sf: str) -> DataFrame:
    """MD2: trees grown until their feature is exhausted predict the train means of its values."""
    rows = _rows(spark, sf)
    scored = _scored(rows, {n: _tree(rows, f) for n, f in TREES.items()}, TREES)
    return _rounded(EV.regression_metrics(stacked(scored, tuple(TREES), ("split", "y"))))


_BLEND = f"{EV.BLEND_WEIGHT} * pq + {1 - EV.BLEND_WEIGHT} * pl"


@query("md4_exact_choice", f"""WITH {LI_SQL},
m AS ({_metric_sql('by_quantity', 'pq')} UNION ALL {_metric_sql('blend', _BLEND)}),
b AS (SELECT max(CASE WHEN model = 'blend' THEN r2 END) > max(CASE WHEN model = 'by_quantity' THEN r2 END) AS better FROM m WHERE split = 'test')
SELECT m.*, CASE WHEN model = 'blend' THEN better ELSE NOT better END AS chosen FROM m, b""")
def md4_exact_choice(spark: SparkSession, sf: str) -> DataFrame:
    """MD4: a blend takes its first model's place only if its test R² is higher."""
    rows = _rows(spark, sf)
    scored = _scored(rows, {n: _tree(rows, f) for n, f in TREES.items()}, TREES)
    both = scored.select("split", "y", "by_quantity", EV.blend(F.col("by_quantity"), F.col("by_line")).alias("blend"))
    metrics = cut_lineage(EV.regression_metrics(stacked(both, ("by_quantity", "blend"), ("split", "y"))))
    return _rounded(EV.keep_blend_if_better(metrics, "by_quantity", "blend"), "chosen")


@query("md5_exact_boost", f"""WITH {LI_SQL}
SELECT CAST(1 AS BIGINT) AS chosen_set, {srnd('1 - sum((y - pq) * (y - pq)) / (var_pop(y) * count(*))')} AS valid_r2 FROM pr WHERE split = 'train'""")
def md5_exact_boost(spark: SparkSession, sf: str) -> DataFrame:
    """MD5, TN2, TN3: of an ensemble that is exact after one round and one of three shallow rounds the first wins on the rows it was grown on."""
    rows = M.assemble_xy(_rows(spark, sf), ["l_quantity"], "l_extendedprice", keep=["is_test"])
    best = M.early_stopped("boost", EXACT_BOOST, rows.where("is_test = 0"), rows.where("is_test = 0"), ["l_quantity"], max_bins=64)
    chosen = 1 + EXACT_BOOST.index(best.params)
    return spark.createDataFrame([(chosen, float(best.score))], "chosen_set bigint, score double").select(
        "chosen_set", rnd("score").alias("valid_r2"))


@query("md3_exact_forest", f"WITH {LI_SQL}\n" + _metric_sql("five_trees", "pq"))
def md3_exact_forest(spark: SparkSession, sf: str) -> DataFrame:
    """MD3: five trees without bootstrap are the same exact tree; the least size of a split is named as left out."""
    rows = _rows(spark, sf)
    data = M.assemble_xy(rows, ["l_quantity"], "l_extendedprice", keep=["is_test"])
    params = {**EXACT_TREE, "n_estimators": 5, "min_samples_split": 2, "min_samples_leaf": 1, "max_features": None}
    model = M.forest(params, without=M.SPLIT_SIZE).setMaxBins(64).fit(data.where("is_test = 0"))
    scored = model.transform(data).select(F.lit("five_trees").alias("model"), F.when(F.col("is_test") == 1, "test").otherwise("train").alias("split"),
                                          F.col("label").alias("y"), F.col("prediction").alias("p"))
    return _rounded(EV.regression_metrics(scored))


@query("md6_exact_boost", f"WITH {LI_SQL}\n" + _metric_sql("boost_b", "pq"))
def md6_exact_boost(spark: SparkSession, sf: str) -> DataFrame:
    """MD6: the second learner's parameter names; one round is exact, and the refit on as many rounds scores all rows."""
    data = M.assemble_xy(_rows(spark, sf), ["l_quantity"], "l_extendedprice", keep=["is_test"])
    train = data.where("is_test = 0")
    sets = [{"iterations": 1, "learning_rate": 0.03, "depth": M.MAX_DEPTH_LIMIT}]
    best = M.early_stopped("boost_b", sets, train, train, ["l_quantity"], max_bins=64)
    scored = M.boosted(best.params, rounds=best.rounds).setMaxBins(64).fit(train).transform(data).select(
        F.lit("boost_b").alias("model"), F.when(F.col("is_test") == 1, "test").otherwise("train").alias("split"),
        F.col("label").alias("y"), F.col("prediction").alias("p"))
    return _rounded(EV.regression_metrics(scored))


@query("tn1_exact_search", f"""WITH li AS (SELECT l_quantity, l_extendedprice AS y, {hash_sql(KEY)} % {KFOLDS} AS fold FROM lineitem),
g AS (SELECT k.fold, l_quantity, avg(y) AS p FROM li, (SELECT range AS fold FROM range(0, {KFOLDS})) k WHERE li.fold <> k.fold GROUP BY ALL),
r AS (SELECT li.fold, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM li JOIN g USING (fold, l_quantity) GROUP BY li.fold)
SELECT CAST(3 AS BIGINT) AS draws, CAST(1 AS BIGINT) AS chosen, {srnd('avg(r2)')} AS best_score, {srnd('avg(r2)')} AS chosen_score FROM r""")
def tn1_exact_search(spark: SparkSession, sf: str) -> DataFrame:
    """TN1: a search among trees that are all exact: the best stored score is the k-fold R² of the group means, and is the chosen draw's."""
    rows = read_table(spark, sf, "lineitem").select(*KEY, "l_quantity", "l_extendedprice").withColumn("fold", kfold(KEY))
    data = cut_lineage(M.assemble_xy(spread(rows, KEY), ["l_quantity"], "l_extendedprice", keep=["fold"]))
    space = {"n_estimators": (1, 3), "max_depth": (29, 30), "bootstrap": (False,)}
    table = M.draw_table(spark, M.model_search(data, ["l_quantity"], space, draws=3, max_bins=64))
    return table.agg(F.count(F.lit(1)).alias("draws"), F.count_if("chosen").alias("chosen"), rnd(F.max("score")).alias("best_score"),
                     rnd(F.max(F.when(F.col("chosen"), F.col("score")))).alias("chosen_score"))


@query("ch1_exact_importance", "SELECT 'l_quantity' AS feature, 1.0 AS importance FROM lineitem GROUP BY ALL HAVING stddev_pop(l_quantity) > 0")
def ch1_exact_importance(spark: SparkSession, sf: str) -> DataFrame:
    """CH1, IMP1, TK1, TK2: of a column and a constant the column has all the gain, and is the first of one."""
    rows = _rows(spark, sf).withColumn("one", F.lit(1.0))
    tree = M.forest(EXACT_TREE).setMaxBins(64).fit(M.assemble_xy(spread(rows, KEY), ["one", "l_quantity"], "l_extendedprice"))
    table = EV.importance_table(spark, ["one", "l_quantity"], list(tree.featureImportances.toArray()))
    return CH.top_importances(table, 1).select("feature", rnd("importance").alias("importance"))


def _model_folder(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    rows = _rows(spark, sf)
    folder = A.artifact_dir(spark, f"scan-{os.path.basename(sf.rstrip('/'))}")
    for name, feature in TREES.items():
        A.save_model(_tree(rows, feature), f"{folder}/{name}")
    rows.limit(1).write.mode("overwrite").parquet(f"{folder}/not_a_model")
    return rows, folder


@query("io9_scan", """SELECT name, kind, error IS NOT NULL AS bad FROM (VALUES
  ('by_line', 'RandomForestRegressionModel', NULL), ('by_quantity', 'RandomForestRegressionModel', NULL),
  ('not_a_model', NULL, 'no readable metadata')) t(name, kind, error)""")
def io9_scan(spark: SparkSession, sf: str) -> DataFrame:
    """IO9: the models of a folder with two of them and a folder that is none."""
    _, folder = _model_folder(spark, sf)
    return A.scan_models(spark, folder).select("name", F.element_at(F.split("kind", "\\."), -1).alias("kind"), F.col("error").isNotNull().alias("bad"))


@query("io9_scan_scores", f"""WITH {LI_SQL}
SELECT 'by_line' AS model, {srnd('avg(abs(y - gl.pl))', 4)} AS mae FROM li JOIN gl ON gl.l_linenumber = li.l_linenumber
UNION ALL SELECT 'by_quantity', {srnd('avg(abs(y - gq.pq))', 4)} FROM li JOIN gq ON gq.l_quantity = li.l_linenumber""")
def io9_scan_scores(spark: SparkSession, sf: str) -> DataFrame:
    """IO5, IO9: all good models of a folder score one table in one projection (its vector holds the line number)."""
    rows, folder = _model_folder(spark, sf)
    models = A.load_scanned(spark, A.scan_models(spark, folder))
    line = M.assemble_xy(rows.withColumn("l_linenumber", F.col("l_linenumber").cast("double")), ["l_linenumber"], "l_extendedprice")
    out = A.score_models(models, line).groupBy("model").agg(F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"))
    return out.select("model", rnd("mae", 4).alias("mae"))


@query("pr1_numeric_columns", f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {srnd('l_quantity')} AS l_quantity,
  {srnd('l_extendedprice')} AS l_extendedprice, {srnd('l_discount')} AS l_discount, {srnd('l_tax')} AS l_tax FROM lineitem""")
def pr1_numeric_columns(spark: SparkSession, sf: str) -> DataFrame:
    """PR1, PR2: the numeric columns by type, some of them dropped by name."""
    li = read_table(spark, sf, "lineitem")
    out = li.select(*numeric_columns(li)).drop("l_partkey", "l_suppkey", "no_such_column")
    return out.select(*[F.col(c).cast("bigint") if c in ("l_orderkey", "l_linenumber") else rnd(c).alias(c) for c in out.columns])


_Z = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_Z_SQL = " + ".join(f"pow(({c} - m_{c}) / s_{c}, 2)" for c in _Z)
_MOMENTS_SQL = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _Z)


@query("ft6_rotation", f"""WITH s AS (SELECT {_MOMENTS_SQL} FROM lineitem)
SELECT {', '.join(KEY)}, {srnd(_Z_SQL)} AS norm FROM lineitem, s""")
def ft6_rotation(spark: SparkSession, sf: str) -> DataFrame:
    """FT2, FT6: all principal components of a row have the norm of its standardised values."""
    li = read_table(spark, sf, "lineitem").select(*KEY, *_Z)
    out = fit_pca(li, _Z, n_components=len(_Z)).transform(li, "pca_")
    return out.select(*KEY, rnd(sum((F.col(f"pca_{j + 1}") * F.col(f"pca_{j + 1}") for j in range(1, len(_Z))), F.col("pca_1") * F.col("pca_1"))).alias("norm"))


_FLAG_SQL = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"


@query("ft4_three_values", f"""WITH f AS (SELECT *, {_FLAG_SQL} AS flag FROM lineitem), s AS (SELECT stddev_pop(flag) AS sd FROM f)
SELECT {', '.join(KEY)}, CAST(flag AS BIGINT) AS label, {', '.join(srnd(f'abs(flag - {j}) / sd') + f' AS d_{j}' for j in range(3))} FROM f, s""")
def ft4_three_values(spark: SparkSession, sf: str) -> DataFrame:
    """FT4, FT5: three clusters of a column with three values have those values as centres, in order."""
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("flag")
    li = read_table(spark, sf, "lineitem").select(*KEY, flag)
    out = fit_kmeans(li, ["flag"], 3).transform(li, "label", "d_")
    return out.select(*KEY, F.col("label").cast("bigint").alias("label"), *[rnd(f"d_{j}").alias(f"d_{j}") for j in range(3)])


def _permuted_sql(salt: int) -> str:
    number = lambda seed: f"row_number() OVER (PARTITION BY b ORDER BY {hash_sql(KEY, seed)}, {', '.join(KEY)})"
    return f"""SELECT {salt} AS rep, a.y, a.l_quantity AS q, a.l_linenumber AS l, c.l_quantity AS pq, c.l_linenumber AS pl FROM
  (SELECT *, {number(104729 + salt)} AS i FROM (SELECT *, {hash_sql(KEY, 7919 + salt)} % 16 AS b FROM te) u) a JOIN
  (SELECT *, {number(1299709 + salt)} AS i FROM (SELECT *, {hash_sql(KEY, 7919 + salt)} % 16 AS b FROM te) u) c ON a.b = c.b AND a.i = c.i"""


_PERM_R2 = "1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))"


@query("ev4_exact", f"""WITH li AS (SELECT *, l_extendedprice AS y, {hash_sql(KEY)} % 100 < 20 AS is_test FROM lineitem),
g AS (SELECT l_quantity AS q, l_linenumber AS l, avg(y) AS p FROM li WHERE NOT is_test GROUP BY ALL),
te AS (SELECT * FROM li WHERE is_test),
base AS (SELECT {_PERM_R2} AS r2 FROM te JOIN g ON g.q = te.l_quantity AND g.l = te.l_linenumber),
c AS ({" UNION ALL ".join(_permuted_sql(s) for s in range(EV.PERM_REPEATS))}),
r AS (SELECT 'l_quantity' AS feature, rep, {_PERM_R2} AS r2 FROM c JOIN g ON g.q = c.pq AND g.l = c.l GROUP BY rep
  UNION ALL SELECT 'l_linenumber', rep, {_PERM_R2} FROM c JOIN g ON g.q = c.q AND g.l = c.pl GROUP BY rep)
SELECT feature, {srnd('avg(base.r2 - r.r2)')} AS importance, {srnd('stddev_pop(base.r2 - r.r2)')} AS std FROM r, base GROUP BY feature
UNION ALL SELECT 'one', 0.0, 0.0""")
def ev4_exact(spark: SparkSession, sf: str) -> DataFrame:
    """EV4, IMP1: permutation importances of a tree that predicts the train mean of each pair of two features' values."""
    rows = _rows(spark, sf).withColumn("one", F.lit(1.0))
    names = ["l_quantity", "l_linenumber", "one"]
    # the key holds the line number, too: the vector takes it as a number of its own
    vec = F.array(*[F.col(c).cast("double") for c in names])
    data = rows.select(*KEY, "is_test", F.col("l_extendedprice").alias("label"), array_to_vector(vec).alias("features"))
    tree = M.forest(EXACT_TREE).setMaxBins(64).fit(spread(data.where("is_test = 0"), KEY))
    out = EV.permutation_importance(tree, data.where("is_test = 1"), names, KEY, buckets=16)
    return out.select("feature", rnd("importance").alias("importance"), rnd("std").alias("std"))


# ---------------------------------------------------------------- AG15

@query("ag15_auto_hist", f"""WITH e AS (SELECT CAST(value AS DOUBLE) AS v FROM events WHERE value IS NOT NULL),
s AS (SELECT count(*) AS n, min(v) AS lo, max(v) AS hi, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM e),
w AS (SELECT lo, hi, least((hi - lo) / (log2(n) + 1), CASE WHEN iqr > 0 THEN 2 * iqr / pow(n, 1.0 / 3) ELSE (hi - lo) END) AS width FROM s),
k AS (SELECT lo, hi, CAST(ceil((hi - lo) / width) AS BIGINT) AS bins FROM w),
b AS (SELECT CAST(range + 1 AS BIGINT) AS bin FROM k, range(0, 100000) WHERE range < bins),
c AS (SELECT least(greatest(CAST(floor((v - lo) / ((hi - lo) / bins)) AS BIGINT) + 1, 1), bins) AS bin, count(*) AS n FROM e, k GROUP BY 1)
SELECT b.bin, {srnd('lo + (b.bin - 1) * ((hi - lo) / bins)')} AS lo, {srnd('lo + b.bin * ((hi - lo) / bins)')} AS hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM b CROSS JOIN k LEFT JOIN c ON c.bin = b.bin""")
def ag15_auto_hist(spark: SparkSession, sf: str) -> DataFrame:
    """AG15: a histogram with as many bins as range, IQR and row count ask for."""
    h = auto_histogram(read_table(spark, sf, "events"), "value")
    return h.select(F.col("bin").cast("bigint").alias("bin"), rnd("lo").alias("lo"), rnd("hi").alias("hi"), "n")


def _kde_sql(col: str) -> str:
    return f"""SELECT '{col}' AS "column", point, {srnd('x')} AS x,
  {srnd(f"sum(c * exp(-pow((x - lo - (bin + 0.5) * w) / h, 2) / 2)) / (n * h * sqrt(2 * pi()))", 9)} AS density FROM (
  SELECT CAST(g.range AS BIGINT) AS point, lo + g.range * ((hi - lo) / 49) AS x, lo, (hi - lo) / {KDE_BINS} AS w, h, s.n, bin, c
  FROM (SELECT count({col}) AS n, stddev_samp({col}) * pow(count({col}), -0.2) AS h, min({col}) AS lo, max({col}) AS hi FROM lineitem) s,
    range(0, 50) g, (SELECT least(CAST(floor((v - lo) / ((hi - lo) / {KDE_BINS})) AS BIGINT), {KDE_BINS - 1}) AS bin, count(*) AS c
      FROM (SELECT CAST({col} AS DOUBLE) AS v FROM lineitem), (SELECT min({col}) AS lo, max({col}) AS hi FROM lineitem) GROUP BY 1)) t
  GROUP BY point, x, n, h, lo, w"""


@query("ag15_kde_binned", _kde_sql("l_extendedprice") + "\nUNION ALL\n" + _kde_sql("l_tax"))
def ag15_kde_binned(spark: SparkSession, sf: str) -> DataFrame:
    """AG15: density curves of two columns from one pass over bin counts."""
    out = kde_binned(read_table(spark, sf, "lineitem"), ["l_extendedprice", "l_tax"])
    return out.select("column", F.col("point").cast("bigint").alias("point"), rnd("x").alias("x"), rnd("density", 9).alias("density"))


# ---------------------------------------------------------------- features of rows that weren't fitted on

def _new_rows_sql() -> str:
    s = f"1.0 / (1.0 + exp(-(g.n - {TE_MIN_SAMPLES_LEAF}) / {TE_SMOOTHING}))"
    return f"""WITH {FACTS_SQL},
f AS (SELECT *, {hash_sql(KEY)} % 100 < 20 AS is_test FROM facts),
tr AS (SELECT * FROM f WHERE NOT is_test),
g AS (SELECT legal_basis, count(*) AS n, avg(fines) AS mean_a, stddev_samp(fines) AS std_a, median(fines) AS med_a, avg(amount) AS mean_y, median(amount) AS med_y,
  stddev_samp(amount) AS std_y, dense_rank() OVER (ORDER BY legal_basis) - 1 AS label FROM tr GROUP BY legal_basis),
a AS (SELECT count(*) AS n, avg(amount) AS prior, median(fines) AS mid, quantile_cont(fines, 0.75) - quantile_cont(fines, 0.25) AS iqr FROM tr),
r AS (SELECT legal_basis, fines, min(rk) AS rk FROM (SELECT legal_basis, fines, rank() OVER (PARTITION BY legal_basis ORDER BY fines) AS rk FROM tr) GROUP BY 1, 2)
SELECT {', '.join('f.' + k for k in KEY)}, {srnd('g.n / a.n')} AS freq, CAST(g.label AS BIGINT) AS label,
  {srnd(f'a.prior * (1 - {s}) + g.mean_y * {s}', 4)} AS te, {srnd('g.mean_a')} AS mean_a, {srnd('g.std_a')} AS std_a, {srnd('g.med_a')} AS med_a,
  {srnd('r.rk / g.n')} AS rank_pct, {srnd('f.fines - g.mean_a')} AS dev, {srnd('g.mean_y', 4)} AS mean_y, {srnd('g.med_y', 4)} AS med_y, {srnd('g.std_y', 4)} AS std_y
FROM f JOIN g USING (legal_basis) JOIN r USING (legal_basis, fines), a WHERE f.is_test"""


@query("e1_new_rows", _new_rows_sql())
def e1_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """E1, EN1-EN3, AG5-AG8, WN1: a feature model fitted on the train rows and applied to the others."""
    rows = facts(spark, sf, materialize=True).withColumn("is_test", holdout_flag(KEY))
    model = fit(rows.where("is_test = 0").drop("is_test"), FACT_ROLES, kmeans_ks=())
    out = model.transform_rows(rows.where("is_test = 1").drop("is_test"), held_out=True)
    k = "legal_basis_label"
    names = {"te": ("legal_basis_te", 4), "mean_a": (f"mean_fines_by_{k}", 6), "std_a": (f"std_fines_by_{k}", 6), "med_a": (f"median_fines_by_{k}", 6),
             "rank_pct": (f"rank_pct_fines_by_{k}", 6), "dev": (f"dev_from_mean_fines_by_{k}", 6), "mean_y": (f"target_mean_by_{k}", 4),
             "med_y": (f"target_median_by_{k}", 4), "std_y": (f"target_std_by_{k}", 4), "freq": ("legal_basis_freq", 6)}
    return out.select(*KEY, F.col(k).cast("bigint").alias("label"), *[rnd(c, d).alias(n) for n, (c, d) in names.items()])


# ---------------------------------------------------------------- merged sketches

@query("ag7_sketch_medians", "SELECT event_type, CAST(count(value) AS BIGINT) AS n, true AS within FROM events GROUP BY event_type")
def ag7_sketch_medians(spark: SparkSession, sf: str) -> DataFrame:
    """AG7, R3 approximate: medians from states per type and hour, merged per type; whether their exact ranks keep the bound."""
    ev = read_table(spark, sf, "events").select("event_type", F.hour("ts").alias("hour"), F.col("value").cast("double").alias("value"))
    stored = write_stage(SK.states(ev, ["event_type", "hour"], ["value"]), "states")
    med = SK.quantiles(SK.merged(stored, ["event_type"]), ["event_type"], "value", [0.5])
    below = join_small(ev, med, "event_type", "inner").groupBy("event_type", "n", "max_rank_error").agg(
        F.count_if(F.col("value") < F.col("q0")).alias("lo"), F.count_if(F.col("value") <= F.col("q0")).alias("hi"))
    err = F.col("max_rank_error") * F.col("n") + 1
    return below.select("event_type", "n", ((F.col("lo") - err <= F.col("n") / 2) & (F.col("n") / 2 <= F.col("hi") + err)).alias("within"))
