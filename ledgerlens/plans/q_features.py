"""Queries: encoders (EN1-EN3, R12, R20), row features (SC2-SC12, R13-R15),
group statistics (AG5-AG8, WN1), scalers (FT1, FT2), RFF (FT3), centroid
distances (FT5) and the target log gate (FT7)."""

from __future__ import annotations

import math


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import encode as EN
from ..operators.bins import fit_quantile_binner
from ..operators.fitted import RFF_GAMMAS, distances_to, fit_random_fourier
from ..operators.groupstats import add_group_stats, target_stats_leaky, target_stats_oof
from ..operators.profile import skewness_g1
from ..operators.scale import fit_minmax_scaler, fit_robust_scaler, fit_standard_scaler
from ..sources.tables import FACT_KEY, FACTS_SQL, facts, read_table
from .registry import query, rnd, sql_lit, srnd

W = f"WITH {FACTS_SQL}"
KEY = list(FACT_KEY)
KEY_SQL = ", ".join(KEY)
FOLDS = 5
SEED = 42


def hash_sql(cols: list[str], seed: int = SEED) -> str:
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"('0x' || substr(md5(concat_ws('|', {parts}, '{seed}')), 1, 8))::BIGINT"


# ---------------------------------------------------------------- EN1

def _sigmoid_sql(n: str, m: str, prior: str, leaf: float = EN.TE_MIN_SAMPLES_LEAF,
                 smooth: float = EN.TE_SMOOTHING) -> str:
    s = f"(1.0 / (1.0 + exp(-(CAST({n} AS DOUBLE) - {float(leaf)!r}) / {float(smooth)!r})))"
    return f"CASE WHEN {n} = 1 THEN {prior} ELSE {prior} * (1.0 - {s}) + {m} * {s} END"


@query("en1_target_sigmoid", f"""WITH p AS (SELECT avg(value) AS prior FROM events),
s AS (SELECT event_type, count(value) AS n, avg(value) AS m FROM events
      WHERE event_type IS NOT NULL GROUP BY 1),
e AS (SELECT event_type, {_sigmoid_sql('n', 'm', 'prior')} AS enc FROM s, p)
SELECT ev.event_id, ev.event_type,
       {srnd('coalesce(e.enc, (SELECT prior FROM p))')} AS event_type_te
FROM events ev LEFT JOIN e ON ev.event_type = e.event_type""")
def en1_target_sigmoid(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events")
    model = EN.fit_target_encoder(ev, ["event_type"], "value", mode="sigmoid")
    return model.transform(ev.select("event_id", "event_type", "value")).select(
        "event_id", "event_type", rnd("event_type_te").alias("event_type_te"))


@query("en1_m_estimate", f"""{W}, p AS (SELECT avg(amount) AS prior FROM facts),
s AS (SELECT municipality, count(amount) AS n, avg(amount) AS m FROM facts GROUP BY 1)
SELECT municipality, {srnd(f'(n * m + {float(EN.M_ESTIMATE_M)!r} * prior) / (n + {float(EN.M_ESTIMATE_M)!r})')} AS municipality_te
FROM s, p""")
def en1_m_estimate(spark: SparkSession, sf: str) -> DataFrame:
    f = facts(spark, sf, materialize=True, columns=("municipality", "amount"))
    model = EN.fit_target_encoder(f, ["municipality"], "amount", mode="m_estimate")
    return model.tables["municipality"].df.select(
        "municipality", rnd("_te_enc").alias("municipality_te"))


@query("en1_target_oof", f"""WITH e AS (
  SELECT event_id, event_type, value, {hash_sql(['event_id'])} % {FOLDS} AS fold FROM events),
tot AS (SELECT sum(value) AS s, count(value) AS n FROM e),
pri AS (SELECT fold, (max(tot.s) - sum(value)) / NULLIF(CAST(max(tot.n) - count(value) AS DOUBLE), 0) AS prior
        FROM e, tot GROUP BY fold),
cs AS (SELECT event_type, fold, count(value) AS cn, sum(value) AS csum FROM e
       WHERE event_type IS NOT NULL GROUP BY 1, 2),
ct AS (SELECT event_type, sum(cn) AS tn, sum(csum) AS ts FROM cs GROUP BY 1),
st AS (SELECT cs.event_type, cs.fold, tn - cn AS o_n,
              (ts - csum) / NULLIF(CAST(tn - cn AS DOUBLE), 0) AS o_m
       FROM cs JOIN ct ON cs.event_type = ct.event_type)
SELECT e.event_id, e.event_type, CAST(e.fold AS INTEGER) AS fold,
  {srnd("CASE WHEN st.o_n IS NULL OR st.o_n = 0 THEN pri.prior ELSE " + _sigmoid_sql('st.o_n', 'st.o_m', 'pri.prior') + " END")} AS event_type_te
FROM e JOIN pri ON e.fold = pri.fold
LEFT JOIN st ON e.event_type = st.event_type AND e.fold = st.fold""")
def en1_target_oof(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events").select("event_id", "event_type", "value")
    out = EN.target_encode_oof(ev, ["event_type"], "value", key=["event_id"], folds=FOLDS)
    return out.select("event_id", "event_type", F.col("_fold").alias("fold"),
                      rnd("event_type_te").alias("event_type_te"))


# ---------------------------------------------------------------- EN2 / EN3

_CATS = ("sector", "municipality", "status", "legal_basis")


@query("en2_freq", f"""{W}
SELECT {KEY_SQL}, """ + ",\n".join(
    srnd(f"CAST(count({c}) OVER (PARTITION BY {c}) AS DOUBLE) / count({c}) OVER ()") + f" AS {c}_freq"
    for c in _CATS) + "\nFROM facts")
def en2_freq(spark: SparkSession, sf: str) -> DataFrame:
    f = facts(spark, sf, materialize=True, columns=_CATS)
    model = EN.fit_frequency_encoder(f, list(_CATS))
    out = model.transform(f)
    return out.select(*KEY, *[rnd(f"{c}_freq").alias(f"{c}_freq") for c in _CATS])


@query("en2_freq_on_encoded", f"""{W}, p AS (SELECT avg(amount) AS prior FROM facts),
s AS (SELECT municipality, count(amount) AS n, avg(amount) AS m FROM facts GROUP BY 1),
enc AS (SELECT municipality, {_sigmoid_sql('n', 'm', 'prior')} AS te FROM s, p),
rows_ AS (SELECT f.municipality, enc.te FROM facts f JOIN enc ON f.municipality = enc.municipality),
fr AS (SELECT te, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM rows_) AS freq FROM rows_ GROUP BY te)
SELECT DISTINCT r.municipality, {srnd('r.te')} AS municipality_te, {srnd('fr.freq')} AS municipality_freq
FROM rows_ r JOIN fr ON r.te = fr.te""")
def en2_freq_on_encoded(spark: SparkSession, sf: str) -> DataFrame:
    """F3 parity: the frequency encoder keyed on the target-encoded floats."""
    f = facts(spark, sf, materialize=True, columns=("municipality", "amount")).select("municipality", F.col("municipality").alias("_orig"), "amount")
    te = EN.fit_target_encoder(f, ["municipality"], "amount", inplace=True).transform(f)
    fr = EN.fit_frequency_encoder(te, ["municipality"]).transform(te)
    return fr.select(F.col("_orig").alias("municipality"),
                     rnd("municipality").alias("municipality_te"),
                     rnd("municipality_freq").alias("municipality_freq")).distinct()


@query("en3_label", f"""{W}
SELECT municipality, CAST(dense_rank() OVER (ORDER BY municipality) - 1 AS BIGINT) AS label
FROM (SELECT DISTINCT municipality FROM facts)""")
def en3_label(spark: SparkSession, sf: str) -> DataFrame:
    model = EN.fit_label_encoder(facts(spark, sf), ["municipality"])
    return model.mapping("municipality").select("municipality", F.col("label").cast("bigint"))


@query("r20_roundtrip", f"""{W}
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_unlabeled,
       CAST(0 AS BIGINT) AS min_label, CAST(count(DISTINCT legal_basis) - 1 AS BIGINT) AS max_label,
       CAST(count(DISTINCT legal_basis) AS BIGINT) AS n_labels
FROM facts""")
def r20_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    f = facts(spark, sf, materialize=True, columns=("legal_basis",))
    return EN.label_roundtrip(f, "legal_basis", EN.fit_label_encoder(f, ["legal_basis"]))


@query("r12_onehot", """SELECT o_orderkey, """ + ",\n".join(
    f"CAST(coalesce(o_orderstatus = '{v}', false) AS INTEGER) AS o_orderstatus_{v}"
    for v in ("F", "O", "P")) + "\nFROM orders")
def r12_onehot(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    out = EN.one_hot(o, "o_orderstatus")
    return out.select("o_orderkey", *[c for c in out.columns if c.startswith("o_orderstatus_")])


# ---------------------------------------------------------------- SC2-SC11, R14, R15

@query("sc2_ratios", f"""{W}
SELECT {KEY_SQL},
  {srnd('fines / (taxpayers + 0.001)')} AS fines_per_taxpayer,
  {srnd('taxpayers / (fines + 0.001)')} AS taxpayers_per_fine,
  {srnd('ln(1 + fines / (taxpayers + 0.001))')} AS ratio_log
FROM facts""")
def sc2_ratios(spark: SparkSession, sf: str) -> DataFrame:
    f = facts(spark, sf)
    r = S.guarded_ratio("fines", "taxpayers")
    return f.select(*KEY, rnd(r).alias("fines_per_taxpayer"),
                    rnd(S.guarded_ratio("taxpayers", "fines")).alias("taxpayers_per_fine"),
                    rnd(S.log1p(r)).alias("ratio_log"))


@query("sc7_calendar", f"""{W}
SELECT {KEY_SQL},
  {srnd('year + month / 12.0')} AS date_numeric,
  CAST(floor((month % 12) / 3) + 1 AS INTEGER) AS season,
  CAST(floor((month - 1) / 3) + 1 AS INTEGER) AS quarter,
  CAST(month >= 6 AND month <= 8 AS INTEGER) AS is_summer,
  CAST(month = 12 OR month <= 2 AS INTEGER) AS is_winter,
  {srnd(f'sin({2 * math.pi!r} * month / 12.0)')} AS month_sin,
  {srnd(f'cos({2 * math.pi!r} * month / 12.0)')} AS month_cos
FROM facts""")
def sc7_calendar(spark: SparkSession, sf: str) -> DataFrame:
    f = facts(spark, sf)
    return f.select(*KEY, rnd(S.date_numeric("year", "month")).alias("date_numeric"),
                    S.season("month").alias("season"), S.quarter_of_month("month").alias("quarter"),
                    S.is_summer("month").alias("is_summer"), S.is_winter("month").alias("is_winter"),
                    rnd(S.month_sin("month")).alias("month_sin"),
                    rnd(S.month_cos("month")).alias("month_cos"))


@query("sc5_poly", f"""{W}
SELECT {KEY_SQL},
  fines * fines AS fines_squared, CAST(taxpayers AS DOUBLE) * taxpayers AS taxpayers_squared,
  fines * fines * fines AS fines_cubed, fines * taxpayers AS fines_x_taxpayers,
  fines * year AS fines_x_year, CAST(taxpayers AS DOUBLE) * year AS taxpayers_x_year
FROM facts""")
def sc5_poly(spark: SparkSession, sf: str) -> DataFrame:
    f = facts(spark, sf)
    return f.select(*KEY, S.power("fines", 2).alias("fines_squared"),
                    S.power("taxpayers", 2).alias("taxpayers_squared"),
                    S.power("fines", 3).alias("fines_cubed"),
                    S.product("fines", "taxpayers").alias("fines_x_taxpayers"),
                    S.product("fines", "year").alias("fines_x_year"),
                    S.product("taxpayers", "year").alias("taxpayers_x_year"))


@query("sc3_log_sqrt", f"""{W}
SELECT {KEY_SQL},
  {srnd('ln(1 + fines)')} AS log_fines, {srnd('sqrt(fines)')} AS sqrt_fines,
  {srnd('ln(1 + taxpayers)')} AS log_taxpayers, {srnd('sqrt(taxpayers)')} AS sqrt_taxpayers
FROM facts""")
def sc3_log_sqrt(spark: SparkSession, sf: str) -> DataFrame:
    """SC3/SC4 behind the PR5 all-positive gate: where it is closed, the columns are left out."""
    f = facts(spark, sf).select(*KEY, "fines", "taxpayers")
    gate = f.agg(F.every(F.coalesce(F.col("fines") > 0, F.lit(False))
                         & F.coalesce(F.col("taxpayers") > 0, F.lit(False)))).first()[0]
    cols = [rnd(S.log1p("fines")).alias("log_fines"), rnd(S.sqrt("fines")).alias("sqrt_fines"),
            rnd(S.log1p("taxpayers")).alias("log_taxpayers"),
            rnd(S.sqrt("taxpayers")).alias("sqrt_taxpayers")]
    return f.select(*KEY, *(cols if gate else []))


@query("r15_days_quarter", """WITH d AS (SELECT o_orderkey, make_date(CAST(year(o_orderdate) AS INTEGER), CAST(month(o_orderdate) AS INTEGER), 1) AS ms FROM orders)
SELECT o_orderkey, ms AS month_start, CAST(quarter(ms) AS BIGINT) AS quarter,
  CAST(dayofweek(ms) + 1 AS BIGINT) AS day_of_week,
  CAST(dayofmonth(last_day(ms)) AS BIGINT) AS days_in_month,
  """ + srnd(f"sin({2 * math.pi!r} * quarter(ms) / 4.0)") + """ AS quarter_sin,
  """ + srnd(f"cos({2 * math.pi!r} * quarter(ms) / 4.0)") + """ AS quarter_cos
FROM d""")
def r15_days_quarter(spark: SparkSession, sf: str) -> DataFrame:
    """R14 + R15: month start date, quarter, day of week, days in month, quarter sin/cos."""
    o = read_table(spark, sf, "orders")
    d = o.select("o_orderkey", S.month_start(F.year("o_orderdate"), F.month("o_orderdate"))
                 .alias("month_start"))
    q = F.quarter("month_start")
    return d.select("o_orderkey", "month_start", q.cast("bigint").alias("quarter"),
                    F.dayofweek("month_start").cast("bigint").alias("day_of_week"),
                    S.days_in_month("month_start").cast("bigint").alias("days_in_month"),
                    rnd(S.quarter_sin(q)).alias("quarter_sin"),
                    rnd(S.quarter_cos(q)).alias("quarter_cos"))


# ---------------------------------------------------------------- SC12

def _qcut_sql(col: str, table: str, q: int, with_facts: bool) -> str:
    probs = ", ".join(repr(i / q) for i in range(q + 1))
    head = f"{W}," if with_facts else "WITH"
    return f"""{head} e AS (SELECT list_sort(list_distinct(quantile_cont({col}, [{probs}]))) AS edges FROM {table}),
b AS (SELECT CAST(greatest(len(list_filter(edges, lambda x: x < {col})) - 1, 0) AS INTEGER) AS bin
      FROM {table}, e WHERE {col} IS NOT NULL)
SELECT bin, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY bin"""


def _qcut_query(spark: SparkSession, sf: str, col: str, q: int = 10) -> DataFrame:
    f = facts(spark, sf, materialize=True, columns=(col,))
    binner = fit_quantile_binner(f, [col], q=q)
    return (f.select(binner.bin_col(col).alias("bin")).where(F.col("bin").isNotNull())
             .groupBy("bin").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


@query("sc12_qcut10", _qcut_sql("fines", "facts", 10, True))
def sc12_qcut10(spark: SparkSession, sf: str) -> DataFrame:
    return _qcut_query(spark, sf, "fines")


@query("sc12_qcut_dups", _qcut_sql("taxpayers", "facts", 10, True))
def sc12_qcut_dups(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicate edges are dropped (pandas ``duplicates='drop'``)."""
    return _qcut_query(spark, sf, "taxpayers")


# ---------------------------------------------------------------- AG5-AG8, WN1

def _group_sql(key: str, cols: list[str]) -> str:
    sel = []
    for c in cols:
        p = f"PARTITION BY {key}"
        sel += [f"{srnd(f'avg({c}) OVER ({p})')} AS mean_{c}_by_{key}",
                f"{srnd(f'coalesce(stddev_samp({c}) OVER ({p}), 0)')} AS std_{c}_by_{key}",
                f"{srnd(f'min({c}) OVER ({p})')} AS min_{c}_by_{key}",
                f"{srnd(f'max({c}) OVER ({p})')} AS max_{c}_by_{key}",
                f"{srnd(f'median({c}) OVER ({p})')} AS median_{c}_by_{key}",
                f"{srnd(f'{c} - avg({c}) OVER ({p})')} AS dev_from_mean_{c}_by_{key}",
                f"{srnd(f'CAST(rank() OVER ({p} ORDER BY {c}) AS DOUBLE) / count(*) OVER ({p})')} AS rank_pct_{c}_by_{key}"]
    return f"{W}\nSELECT {KEY_SQL}, " + ",\n  ".join(sel) + "\nFROM facts"


def _group_cols(key: str, cols: list[str]) -> list[str]:
    return [f"{s}_{c}_by_{key}" for c in cols
            for s in ("mean", "std", "min", "max", "median", "dev_from_mean", "rank_pct")]


@query("ag5_group_stats", _group_sql("legal_basis", ["fines", "taxpayers"]), headline=True)
def ag5_group_stats(spark: SparkSession, sf: str) -> DataFrame:
    f = facts(spark, sf, materialize=True, columns=("legal_basis", "fines", "taxpayers"))
    out = add_group_stats(f, "legal_basis", ["fines", "taxpayers"])
    return out.select(*KEY, *[rnd(c).alias(c) for c in _group_cols("legal_basis", ["fines", "taxpayers"])])


@query("wn1_rank_pct", f"""{W}
SELECT {KEY_SQL}, {srnd('CAST(rank() OVER (PARTITION BY municipality ORDER BY amount) AS DOUBLE) / count(*) OVER (PARTITION BY municipality)')} AS rank_pct_amount_by_municipality
FROM facts""", headline=True)
def wn1_rank_pct(spark: SparkSession, sf: str) -> DataFrame:
    f = facts(spark, sf, materialize=True, columns=("municipality", "amount"))
    out = add_group_stats(f, "municipality", ["amount"], stats=("mean",), dev=False)
    return out.select(*KEY, rnd("rank_pct_amount_by_municipality").alias("rank_pct_amount_by_municipality"))


@query("ag8_target_leaky", """SELECT event_id,
  """ + srnd("avg(value) OVER (PARTITION BY event_type)") + """ AS target_mean_by_event_type,
  """ + srnd("median(value) OVER (PARTITION BY event_type)") + """ AS target_median_by_event_type,
  """ + srnd("coalesce(stddev_samp(value) OVER (PARTITION BY event_type), 0)") + """ AS target_std_by_event_type,
  """ + srnd("value - avg(value) OVER (PARTITION BY event_type)") + """ AS target_dev_from_mean_by_event_type
FROM events""")
def ag8_target_leaky(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events").select("event_id", "event_type", "value")
    out = target_stats_leaky(ev, "event_type", "value")
    return out.select("event_id", *[rnd(f"target_{s}_by_event_type").alias(f"target_{s}_by_event_type")
                                    for s in ("mean", "median", "std", "dev_from_mean")])


@query("ag8_target_oof", f"""WITH e AS (
  SELECT event_id, event_type, value, {hash_sql(['event_id'])} % {FOLDS} AS fold FROM events),
st AS (SELECT k.event_type, k.fold, avg(o.value) AS m, median(o.value) AS md,
              coalesce(stddev_samp(o.value), 0) AS sd
       FROM (SELECT DISTINCT event_type, fold FROM e) k
       JOIN e o ON o.event_type = k.event_type AND o.fold <> k.fold
       GROUP BY k.event_type, k.fold)
SELECT e.event_id, CAST(e.fold AS INTEGER) AS fold,
  {srnd('st.m')} AS target_mean_by_event_type, {srnd('st.md')} AS target_median_by_event_type,
  {srnd('st.sd')} AS target_std_by_event_type
FROM e LEFT JOIN st ON e.event_type = st.event_type AND e.fold = st.fold""", headline=True)
def ag8_target_oof(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events").select("event_id", "event_type", "value")
    out = target_stats_oof(ev, "event_type", "value", ["event_id"], folds=FOLDS)
    return out.select("event_id", F.col("_fold").alias("fold"),
                      *[rnd(f"target_{s}_by_event_type").alias(f"target_{s}_by_event_type")
                        for s in ("mean", "median", "std")])


# ---------------------------------------------------------------- FT1, FT2, R13

_LI = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_LI_KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


def _scaler_sql(kind: str) -> str:
    if kind == "robust":
        stats = ", ".join(f"quantile_cont({c}, 0.5) AS c_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}" for c in _LI)
    elif kind == "standard":
        stats = ", ".join(f"avg({c}) AS c_{c}, stddev_pop({c}) AS s_{c}" for c in _LI)
    else:
        stats = ", ".join(f"min({c}) AS c_{c}, max({c}) - min({c}) AS s_{c}" for c in _LI)
    cols = ", ".join(srnd(f"({c} - c_{c}) / (CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END)") + f" AS {c}"
                     for c in _LI)
    return f"WITH st AS (SELECT {stats} FROM lineitem)\nSELECT {_LI_KEY}, {cols} FROM lineitem, st"


def _scaled(spark: SparkSession, sf: str, fit) -> DataFrame:
    li = read_table(spark, sf, "lineitem").select(*KEY, *_LI)
    out = fit(li, list(_LI)).transform(li)
    return out.select(*KEY, *[rnd(c).alias(c) for c in _LI])


@query("ft1_robust", _scaler_sql("robust"), headline=True)
def ft1_robust(spark: SparkSession, sf: str) -> DataFrame:
    return _scaled(spark, sf, fit_robust_scaler)


@query("ft2_standard", _scaler_sql("standard"))
def ft2_standard(spark: SparkSession, sf: str) -> DataFrame:
    return _scaled(spark, sf, fit_standard_scaler)


@query("r13_minmax", _scaler_sql("minmax"))
def r13_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return _scaled(spark, sf, fit_minmax_scaler)


# ---------------------------------------------------------------- FT3

def _rff_name(gamma: float, j: int) -> str:
    return f"rbf_g{str(gamma).replace('.', 'p')}_{j}"


def _rff_sql() -> str:
    rs = ", ".join(f"quantile_cont({c}, 0.5) AS c_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}"
                   for c in ("fines", "taxpayers"))
    xs = {c: f"(({c} - c_{c}) / (CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END))" for c in ("fines", "taxpayers")}
    cols = []
    for g in RFF_GAMMAS:
        rf = fit_random_fourier(["fines", "taxpayers"], g)
        amp = math.sqrt(2.0 / rf.weights.shape[1])
        for j in range(rf.weights.shape[1]):
            z = f"{sql_lit(rf.offsets[j])} + {xs['fines']} * {sql_lit(rf.weights[0, j])} + {xs['taxpayers']} * {sql_lit(rf.weights[1, j])}"
            cols.append(srnd(f"{sql_lit(amp)} * cos({z})") + f" AS {_rff_name(g, j)}")
    return f"{W}, st AS (SELECT {rs} FROM facts)\nSELECT {KEY_SQL}, " + ",\n  ".join(cols) + "\nFROM facts, st"


@query("ft3_rff", _rff_sql())
def ft3_rff(spark: SparkSession, sf: str) -> DataFrame:
    """FT1 robust scaling of (fines, taxpayers), then FT3 random Fourier features."""
    f = facts(spark, sf, materialize=True, columns=("fines", "taxpayers"))
    scaled = fit_robust_scaler(f, ["fines", "taxpayers"]).transform(f)
    cols = []
    for g in RFF_GAMMAS:
        rf = fit_random_fourier(["fines", "taxpayers"], g)
        cols += [rnd(e).alias(_rff_name(g, j)) for j, e in enumerate(rf.columns())]
    return scaled.select(*KEY, *cols)


# ---------------------------------------------------------------- FT5

@query("ft5_centroid_dist", """WITH ex AS (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i
  FROM embeddings),
c AS (SELECT label AS centroid, i, avg(v) AS cv FROM ex GROUP BY label, i)
SELECT ex.vec_id, CAST(c.centroid AS BIGINT) AS centroid, """ + srnd("sqrt(sum((ex.v - c.cv) * (ex.v - c.cv)))") + """ AS dist
FROM ex JOIN c ON ex.i = c.i GROUP BY ex.vec_id, c.centroid""")
def ft5_centroid_dist(spark: SparkSession, sf: str) -> DataFrame:
    """Distance of every vector to every class centroid (centroids fitted from the data)."""
    emb = read_table(spark, sf, "embeddings")
    ex = emb.select("label", F.posexplode("embedding").alias("i", "v"))
    cent = ex.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("cv"))
    cent = cent.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "cv"))), lambda x: x["cv"]).alias("c"))
    out = distances_to(emb.select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("z")), cent, "z", "c")
    return out.select("vec_id", F.col("label").cast("bigint").alias("centroid"), rnd("distance").alias("dist"))


# ---------------------------------------------------------------- FT7

@query("ft7_target_log", """SELECT doc_id, """ + srnd(
    "CASE WHEN (SELECT skewness(n_chars) FROM documents) > 1 THEN ln(1 + n_chars) ELSE n_chars END") + """ AS y
FROM documents""")
def ft7_target_log(spark: SparkSession, sf: str) -> DataFrame:
    """AG9 gate: log1p the target only when its G1 skewness exceeds 1."""
    docs = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    g1 = skewness_g1(docs, "n_chars")
    y = S.log1p("n_chars") if g1 is not None and g1 > 1.0 else F.col("n_chars").cast("double")
    return docs.select("doc_id", rnd(y).alias("y"))
