"""Queries: correlation and selection (AG10, AG11, PR11, TK3, TK4, R19, FS1, TK6),
splits (SP1-SP3), metrics on deterministic predictors (EV1-EV6, TK5, MD4,
AG13, AG14/CH6, CH3), the KDE (AG15) and set operations (ST1, PR7-PR9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import select as SEL
from ..operators.bins import histogram, kde, range_table
from ..operators.lookup import Lookup
from ..operators.split import holdout_flag, kfold, stratified_split
from ..sources.files import drop_empty, union_by_name
from ..sources.tables import FACTS_SQL, facts, read_table
from .q_features import hash_sql
from .registry import query, rnd, srnd

W = f"WITH {FACTS_SQL}"
FEATS = ("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey", "l_orderkey")
TARGET = "l_extendedprice"


# ---------------------------------------------------------------- AG11, TK3, TK4

def _target_corr_sql() -> str:
    parts = [f"SELECT '{c}' AS feature, corr({c}, {TARGET}) AS r FROM lineitem" for c in FEATS]
    return "WITH c AS (" + " UNION ALL ".join(parts) + ")"


@query("ag11_target_corr", _target_corr_sql() + f"\nSELECT feature, {srnd('r')} AS r FROM c")
def ag11_target_corr(spark: SparkSession, sf: str) -> DataFrame:
    c = SEL.target_correlations(read_table(spark, sf, "lineitem"), FEATS, TARGET)
    return c.select("feature", rnd("r").alias("r"))


@query("tk3_top5", _target_corr_sql() + f"""
SELECT CAST(row_number() OVER (ORDER BY abs(r) DESC, feature) AS BIGINT) AS position, feature, {srnd('r')} AS r
FROM (SELECT * FROM c ORDER BY abs(r) DESC NULLS LAST, feature LIMIT 5)""")
def tk3_top5(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    c = SEL.target_correlations(read_table(spark, sf, "lineitem"), FEATS, TARGET)
    top = SEL.top_by_abs(c, 5)
    w = Window.orderBy(F.abs("r").desc(), F.col("feature"))
    return top.select(F.row_number().over(w).cast("bigint").alias("position"), "feature",
                      rnd("r").alias("r"))


@query("tk4_top15_signed", _target_corr_sql() + f"""
SELECT CAST(row_number() OVER (ORDER BY r DESC, feature) AS BIGINT) AS position, feature, {srnd('r')} AS r
FROM (SELECT * FROM c WHERE feature <> 'l_orderkey' ORDER BY abs(r) DESC NULLS LAST, feature LIMIT 15)""")
def tk4_top15_signed(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    c = SEL.target_correlations(read_table(spark, sf, "lineitem"), FEATS, TARGET)
    top = SEL.top_signed(c, 15, exclude=["l_orderkey"])
    w = Window.orderBy(F.col("r").desc(), F.col("feature"))
    return top.select(F.row_number().over(w).cast("bigint").alias("position"), "feature",
                      rnd("r").alias("r"))


# ---------------------------------------------------------------- AG10, PR11

MATRIX = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax")


def _matrix_sql() -> str:
    parts = []
    for i, a in enumerate(MATRIX):
        for j, b in enumerate(MATRIX):
            if i > j:
                parts.append(f"SELECT CAST({i} AS BIGINT) AS i, CAST({j} AS BIGINT) AS j, '{a}' AS feature_i, "
                             f"'{b}' AS feature_j, {srnd(f'corr({a}, {b})')} AS r FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@query("ag10_corr_lower", _matrix_sql())
def ag10_corr_lower(spark: SparkSession, sf: str) -> DataFrame:
    m = SEL.lower_triangle(SEL.correlation_matrix(read_table(spark, sf, "lineitem"), MATRIX))
    return m.select(F.col("i").cast("bigint"), F.col("j").cast("bigint"), "feature_i", "feature_j",
                    rnd("r").alias("r"))


# ---------------------------------------------------------------- R19

PRUNE = ("fines", "taxpayers", "fines_squared", "fines_x_taxpayers", "amount", "year", "month")


def _prune_frame(spark: SparkSession, sf: str) -> DataFrame:
    f = facts(spark, sf)
    return f.select("fines", "taxpayers", (F.col("fines") * F.col("fines")).alias("fines_squared"),
                    (F.col("fines") * F.col("taxpayers")).alias("fines_x_taxpayers"),
                    "amount", "year", "month")


def _prune_sql() -> str:
    cols = ", ".join(["fines", "taxpayers", "fines * fines AS fines_squared",
                      "fines * taxpayers AS fines_x_taxpayers", "amount", "year", "month"])
    near = ", ".join(f"coalesce(abs(corr({a}, {b})) > 0.95, false) AS n{i}_{j}"
                     for j, b in enumerate(PRUNE) for i, a in enumerate(PRUNE[:j]))
    # a column stays unless it is near one that stayed before it
    steps = ["k0 AS (SELECT *, true AS kept0 FROM c)"] + [
        f"k{j} AS (SELECT *, NOT ({' OR '.join(f'(kept{i} AND n{i}_{j})' for i in range(j))}) AS kept{j} FROM k{j - 1})"
        for j in range(1, len(PRUNE))]
    rows = [f"SELECT '{b}' AS feature, CAST({j} AS INTEGER) AS position, kept{j} AS kept FROM k{len(PRUNE) - 1}" for j, b in enumerate(PRUNE)]
    return f"{W}, x AS (SELECT {cols} FROM facts), c AS (SELECT {near} FROM x), {', '.join(steps)}\n" + "\nUNION ALL\n".join(rows)


@query("r19_prune", _prune_sql())
def r19_prune(spark: SparkSession, sf: str) -> DataFrame:
    return SEL.prune_correlated(_prune_frame(spark, sf), PRUNE)


# ---------------------------------------------------------------- FS1, TK6

MI_FEATS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")


def _mi_sql(q: int = 10) -> str:
    probs = ", ".join(repr(i / q) for i in range(q + 1))
    edges = ", ".join(f"list_sort(list_distinct(quantile_cont({c}, [{probs}]))) AS e_{c}"
                      for c in (*MI_FEATS, TARGET))

    def b(c):
        return f"greatest(len(list_filter(e_{c}, lambda x: x < {c})) - 1, 0)"
    parts = [f"SELECT '{c}' AS feature, {b(c)} AS bx, {b(TARGET)} AS by_ FROM lineitem, e" for c in MI_FEATS]
    return f"""WITH e AS (SELECT {edges} FROM lineitem),
long AS ({' UNION ALL '.join(parts)}),
j AS (SELECT feature, bx, by_, CAST(count(*) AS DOUBLE) AS nxy FROM long GROUP BY ALL),
fx AS (SELECT feature, bx, sum(nxy) AS nx FROM j GROUP BY ALL),
fy AS (SELECT feature, by_, sum(nxy) AS ny FROM j GROUP BY ALL),
ft AS (SELECT feature, sum(nxy) AS nt FROM j GROUP BY ALL)
SELECT j.feature, {srnd('sum((nxy / nt) * ln((nxy * nt) / (nx * ny)))')} AS mi
FROM j JOIN fx USING (feature, bx) JOIN fy USING (feature, by_) JOIN ft USING (feature)
GROUP BY j.feature"""


@query("fs1_binned_mi", _mi_sql(), headline=True)
def fs1_binned_mi(spark: SparkSession, sf: str) -> DataFrame:
    mi = SEL.binned_mutual_information(read_table(spark, sf, "lineitem"), MI_FEATS, TARGET)
    return mi.select("feature", rnd("mi").alias("mi"))


# ---------------------------------------------------------------- SP1-SP3

@query("sp1_stratified", f"""WITH e AS (SELECT event_id, value, {hash_sql(['event_id'])} AS h FROM events),
ed AS (SELECT list_sort(list_distinct(quantile_cont(value, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges FROM e),
b AS (SELECT event_id, h, CAST(greatest(len(list_filter(edges, lambda x: x < value)) - 1, 0) AS INTEGER) AS stratum FROM e, ed),
r AS (SELECT event_id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY h, event_id) AS rn,
             count(*) OVER (PARTITION BY stratum) AS n FROM b)
SELECT event_id, stratum, CAST(rn <= round(n * 0.2) AS INTEGER) AS is_test FROM r""", headline=True)
def sp1_stratified(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events").select("event_id", "value")
    return stratified_split(ev, "value", ["event_id"]).select("event_id", "stratum", "is_test")


@query("sp2_holdout", f"""SELECT event_id, CAST({hash_sql(['event_id'])} % 100 < 20 AS INTEGER) AS is_val FROM events""")
def sp2_holdout(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events")
    return ev.select("event_id", holdout_flag(["event_id"]).alias("is_val"))


@query("sp3_kfold", f"""SELECT event_id, CAST({hash_sql(['event_id'])} % 3 AS INTEGER) AS fold FROM events""")
def sp3_kfold(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events")
    return ev.select("event_id", kfold(["event_id"]).alias("fold"))


# ---------------------------------------------------------------- deterministic predictors

PREDICTORS = (("type_mean", "event_type"), ("hour_mean", "hour"))


def prediction_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Two group-mean predictors fitted on the SP2 train rows of ``events``.

    ``type_mean``: mean value by event_type; ``hour_mean``: mean value by hour
    of ``ts``; unseen keys fall back to the train mean.  One row per event:
    ``(split, event_id, y, type_mean, hour_mean)``.
    """
    ev = read_table(spark, sf, "events").select(
        "event_id", "event_type", F.hour("ts").alias("hour"), F.col("value").cast("double").alias("y"),
        holdout_flag(["event_id"]).alias("_val"))
    ev = ev.withColumn("split", F.when(F.col("_val") == 1, "test").otherwise("train")).drop("_val")
    train = ev.where(F.col("split") == "train")
    mu = train.agg(F.avg("y")).first()[0]
    for name, key in PREDICTORS:
        # one row per key value: broadcast only behind a counted size
        means = Lookup.materialise(train.groupBy(key).agg(F.avg("y").alias(f"_{name}")))
        ev = means.join_to(ev, key, "left").withColumn(name, F.coalesce(F.col(f"_{name}"), F.lit(mu)))
    return ev.select("split", "event_id", "y", *[name for name, _ in PREDICTORS])


def stacked(wide: DataFrame, models: tuple[str, ...], keep: tuple[str, ...] = ("split", "event_id", "y")) -> DataFrame:
    """Long form ``(model, order, keep..., p)`` of predictions that stand in columns."""
    parts = [F.struct(F.lit(m).alias("model"), F.lit(i).alias("order"), F.col(m).alias("p")) for i, m in enumerate(models)]
    return wide.select(*keep, F.explode(F.array(*parts)).alias("_m")).select("_m.model", "_m.order", *keep, "_m.p")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """``prediction_columns`` in long form ``(model, order, split, event_id, y, p)``."""
    return stacked(prediction_columns(spark, sf), tuple(name for name, _ in PREDICTORS))


PRED_SQL = f"""ev AS (SELECT event_id, event_type, hour(ts) AS hour, CAST(value AS DOUBLE) AS y,
  CASE WHEN {hash_sql(['event_id'])} % 100 < 20 THEN 'test' ELSE 'train' END AS split FROM events),
tr AS (SELECT * FROM ev WHERE split = 'train'),
mu AS (SELECT avg(y) AS m FROM tr),
mt AS (SELECT event_type, avg(y) AS m FROM tr GROUP BY 1),
mh AS (SELECT hour, avg(y) AS m FROM tr GROUP BY 1),
pred AS (
  SELECT 'type_mean' AS model, 0 AS ord, ev.split, ev.event_id, ev.y, coalesce(mt.m, (SELECT m FROM mu)) AS p
  FROM ev LEFT JOIN mt ON ev.event_type = mt.event_type
  UNION ALL
  SELECT 'hour_mean' AS model, 1 AS ord, ev.split, ev.event_id, ev.y, coalesce(mh.m, (SELECT m FROM mu)) AS p
  FROM ev LEFT JOIN mh ON ev.hour = mh.hour)"""

METRICS_SQL = """SELECT model, split, CAST(count(*) AS BIGINT) AS n,
  {mae} AS mae, {rmse} AS rmse, {r2} AS r2 FROM {src} GROUP BY model, split"""


def _metric_cols_sql(src: str = "pred") -> str:
    return METRICS_SQL.format(
        mae=srnd("avg(abs(y - p))"), rmse=srnd("sqrt(avg((y - p) * (y - p)))"),
        r2=srnd("CASE WHEN var_pop(y) = 0 THEN CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END "
                "ELSE 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END"), src=src)


def _rounded_metrics(m: DataFrame) -> DataFrame:
    return m.select("model", "split", "n", rnd("mae").alias("mae"), rnd("rmse").alias("rmse"),
                    rnd("r2").alias("r2"))


@query("ev1_metrics", f"WITH {PRED_SQL}\n{_metric_cols_sql()}", headline=True)
def ev1_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_metrics(EV.regression_metrics(predictions(spark, sf)))


BLEND_SQL = f"""bl AS (SELECT 'blend' AS model, 2 AS ord, a.split, a.event_id, a.y, 0.7 * a.p + {1.0 - 0.7!r} * b.p AS p
  FROM pred a JOIN pred b ON a.event_id = b.event_id AND a.model = 'type_mean' AND b.model = 'hour_mean'),
allp AS (SELECT * FROM pred UNION ALL SELECT * FROM bl)"""


def blended(spark: SparkSession, sf: str) -> DataFrame:
    """Both predictors and their blend: the blend is made in the row, then all are stacked once."""
    wide = prediction_columns(spark, sf).withColumn("blend", EV.blend(F.col("type_mean"), F.col("hour_mean")))
    return stacked(wide, ("type_mean", "hour_mean", "blend"))


@query("ev2_compare", f"WITH {PRED_SQL}, {BLEND_SQL}\n" + _metric_cols_sql("allp").replace(
    "GROUP BY model, split", "WHERE split = 'test' GROUP BY model, split"))
def ev2_compare(spark: SparkSession, sf: str) -> DataFrame:
    """EV2 / CH4 / CH5: every model (incl. the MD4 blend) scored on the test split."""
    allp = blended(spark, sf).where(F.col("split") == "test")
    return _rounded_metrics(EV.regression_metrics(allp))


@query("ev3_gap", f"""WITH {PRED_SQL}, {BLEND_SQL}, m AS ({_metric_cols_sql('allp').replace(
    srnd("CASE WHEN var_pop(y) = 0 THEN CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END "
         "ELSE 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END"),
    "1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))")})
SELECT model, {srnd("max(CASE WHEN split = 'train' THEN r2 END)")} AS r2_train,
       {srnd("max(CASE WHEN split = 'test' THEN r2 END)")} AS r2_test,
       {srnd("max(CASE WHEN split = 'train' THEN r2 END) - max(CASE WHEN split = 'test' THEN r2 END)")} AS r2_gap
FROM m GROUP BY model""")
def ev3_gap(spark: SparkSession, sf: str) -> DataFrame:
    """EV3 (the blend is included, unlike the reference's key mix-up)."""
    m = EV.regression_metrics(blended(spark, sf))
    g = EV.r2_gap(m)
    return g.select("model", rnd("r2_train").alias("r2_train"), rnd("r2_test").alias("r2_test"),
                    rnd("r2_gap").alias("r2_gap"))


@query("tk5_best", f"""WITH {PRED_SQL}, {BLEND_SQL},
m AS (SELECT model, min(ord) AS ord, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2
      FROM allp WHERE split = 'test' GROUP BY model),
b AS (SELECT * FROM m ORDER BY coalesce(r2, 0) DESC, ord ASC LIMIT 1)
SELECT model, {srnd('r2')} AS best_r2, coalesce(r2, 0) >= 0.9 AS achieved,
       {srnd('CASE WHEN coalesce(r2, 0) < 0.9 THEN (0.9 - coalesce(r2, 0)) * 100 ELSE 0.0 END')} AS distance_pct
FROM b""")
def tk5_best(spark: SparkSession, sf: str) -> DataFrame:
    """TK5 + EV6: best model on the test split and the R² >= 0.9 verdict."""
    allp = blended(spark, sf).where(F.col("split") == "test")
    m = EV.regression_metrics(allp, by=("model", "order"))
    b = EV.best_model(m)
    return b.select("model", rnd("best_r2").alias("best_r2"), "achieved",
                    rnd("distance_pct").alias("distance_pct"))


@query("md4_blend", f"""WITH {PRED_SQL}, {BLEND_SQL},
m AS (SELECT model, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2,
             avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse
      FROM allp WHERE split = 'test' AND model IN ('blend', 'type_mean') GROUP BY model)
SELECT {srnd("max(CASE WHEN model = 'blend' THEN mae END)")} AS mae,
       {srnd("max(CASE WHEN model = 'blend' THEN rmse END)")} AS rmse,
       {srnd("max(CASE WHEN model = 'blend' THEN r2 END)")} AS r2,
       max(CASE WHEN model = 'blend' THEN r2 END) > max(CASE WHEN model = 'type_mean' THEN r2 END) AS improves
FROM m""")
def md4_blend(spark: SparkSession, sf: str) -> DataFrame:
    """MD4: 0.7/0.3 blend; kept only if it beats the first model's test R²."""
    allp = blended(spark, sf).where(
        (F.col("split") == "test") & F.col("model").isin("blend", "type_mean"))
    m = EV.regression_metrics(allp, by=("model",))
    piv = m.groupBy().pivot("model", ["blend", "type_mean"]).agg(
        F.first(F.struct("mae", "rmse", "r2")))
    return piv.select(rnd("blend.mae").alias("mae"), rnd("blend.rmse").alias("rmse"),
                      rnd("blend.r2").alias("r2"),
                      (F.col("blend.r2") > F.col("type_mean.r2")).alias("improves"))


ERR_SQL = f"""er AS (SELECT event_id, y, p, y - p AS e FROM pred WHERE model = 'type_mean' AND split = 'test')"""


@query("ev5_errors", f"""WITH {PRED_SQL}, {ERR_SQL}
SELECT event_id, {srnd('y')} AS actual, {srnd('p')} AS predicted, {srnd('e')} AS error,
       {srnd('abs(e)')} AS abs_error, {srnd('100.0 * abs(e / (y + 1e-10))')} AS percent_error
FROM er""")
def ev5_errors(spark: SparkSession, sf: str) -> DataFrame:
    pred = predictions(spark, sf).where((F.col("model") == "type_mean") & (F.col("split") == "test"))
    t = EV.error_table(pred, keep=["event_id"])
    return t.select("event_id", *[rnd(c).alias(c) for c in
                                  ("actual", "predicted", "error", "abs_error", "percent_error")])


def _hist_sql(src: str, col: str, bins: int = 30) -> str:
    return f"""r AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {src}),
c AS (SELECT CAST(least(greatest(floor(({col} - lo) / ((hi - lo) / {bins})) + 1, 1), {bins}) AS INTEGER) AS bin,
             count(*) AS n FROM {src}, r WHERE {col} IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, {bins + 1}))
SELECT g.bin, {srnd(f'lo + (g.bin - 1) * ((hi - lo) / {bins})')} AS lo, {srnd(f'lo + g.bin * ((hi - lo) / {bins})')} AS hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM g CROSS JOIN r LEFT JOIN c ON g.bin = c.bin"""


def _round_hist(h: DataFrame) -> DataFrame:
    return h.select("bin", rnd("lo").alias("lo"), rnd("hi").alias("hi"), "n")


@query("ch3_residual_hist", f"WITH {PRED_SQL}, {ERR_SQL}, " + _hist_sql("er", "e"))
def ch3_residual_hist(spark: SparkSession, sf: str) -> DataFrame:
    """CH3 / AG14: 30-bin histogram of the test residuals (empty bins included)."""
    pred = predictions(spark, sf).where((F.col("model") == "type_mean") & (F.col("split") == "test"))
    err = EV.error_table(pred)
    return _round_hist(histogram(err, "error"))


@query("ch6_percent_error_hist", f"WITH {PRED_SQL}, {ERR_SQL}, ep AS (SELECT 100.0 * abs(e / (y + 1e-10)) AS pe FROM er), "
       + _hist_sql("ep", "pe"))
def ch6_percent_error_hist(spark: SparkSession, sf: str) -> DataFrame:
    """CH6: 30-bin histogram of the percent errors."""
    pred = predictions(spark, sf).where((F.col("model") == "type_mean") & (F.col("split") == "test"))
    err = EV.error_table(pred)
    return _round_hist(histogram(err, "percent_error"))


@query("ag13_range", f"""WITH {PRED_SQL}, {ERR_SQL}
SELECT {srnd('least(min(y), min(p))')} AS lo, {srnd('greatest(max(y), max(p))')} AS hi FROM er""")
def ag13_range(spark: SparkSession, sf: str) -> DataFrame:
    """AG13 / CH2: identity-line range over actual and predicted values."""
    pred = predictions(spark, sf).where((F.col("model") == "type_mean") & (F.col("split") == "test"))
    r = range_table(pred, ["y", "p"])
    return r.select(rnd("lo").alias("lo"), rnd("hi").alias("hi"))


@query("ag14_value_hist", "WITH " + _hist_sql("events", "value"))
def ag14_value_hist(spark: SparkSession, sf: str) -> DataFrame:
    return _round_hist(histogram(read_table(spark, sf, "events"), "value"))


@query("ag15_kde", """WITH s AS (SELECT count(value) AS n, stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi FROM events),
h AS (SELECT n, lo, hi, sd * pow(n, -0.2) AS bw FROM s),
g AS (SELECT CAST(range AS INTEGER) AS point, lo + range * ((hi - lo) / 49) AS x FROM range(0, 50), h)
SELECT g.point, """ + srnd("g.x") + """ AS x,
  """ + srnd("sum(exp(-((e.value - g.x) * (e.value - g.x)) / (2 * h.bw * h.bw))) * (1.0 / (max(h.n) * max(h.bw) * sqrt(2 * pi())))", 12) + """ AS density
FROM g CROSS JOIN h CROSS JOIN events e GROUP BY g.point, g.x""")
def ag15_kde(spark: SparkSession, sf: str) -> DataFrame:
    k = kde(read_table(spark, sf, "events"), "value")
    return k.select("point", rnd("x").alias("x"), rnd("density", 12).alias("density"))


# ---------------------------------------------------------------- ST1, PR7-PR9

def _parties(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"),
        F.lit("customer").alias("source"))
    s = read_table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("source"))
    return c, s


PARTIES_SQL = """u AS (
  SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment, 'customer' AS source FROM customer
  UNION ALL
  SELECT s_suppkey AS id, s_name AS name, s_acctbal AS acctbal, NULL AS segment, 'supplier' AS source FROM supplier)"""


@query("st1_union", f"WITH {PARTIES_SQL}\nSELECT id, name, {srnd('acctbal')} AS acctbal, segment, source FROM u")
def st1_union(spark: SparkSession, sf: str) -> DataFrame:
    c, s = _parties(spark, sf)
    u = union_by_name([c, s])
    return u.select("id", "name", rnd("acctbal").alias("acctbal"), "segment", "source")


@query("pr7_drop_all_null", f"""WITH {PARTIES_SQL},
x AS (SELECT CASE WHEN acctbal < 0 THEN NULL ELSE id END AS id,
             CASE WHEN acctbal < 0 THEN NULL ELSE name END AS name,
             CASE WHEN acctbal < 0 THEN NULL ELSE acctbal END AS acctbal,
             CASE WHEN acctbal < 0 THEN NULL ELSE segment END AS segment,
             CASE WHEN acctbal < 0 THEN NULL ELSE source END AS source
      FROM u)
SELECT id, name, {srnd('acctbal')} AS acctbal, segment, source FROM x
WHERE id IS NOT NULL OR name IS NOT NULL OR acctbal IS NOT NULL OR segment IS NOT NULL OR source IS NOT NULL""")
def pr7_drop_all_null(spark: SparkSession, sf: str) -> DataFrame:
    """PR7 + PR8: rows with a negative balance are blanked entirely and an
    all-null column is added; cleaning drops both."""
    c, s = _parties(spark, sf)
    u = union_by_name([c, s])
    neg = F.col("acctbal") < 0
    blank = u.select(*[F.when(~neg, F.col(x)).alias(x) for x in u.columns],
                     F.lit(None).cast("string").alias("phone"))
    clean = drop_empty(blank)
    return clean.select("id", "name", rnd("acctbal").alias("acctbal"), "segment", "source")
