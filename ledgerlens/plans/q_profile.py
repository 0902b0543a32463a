"""Queries: trends (R6-R11, R16-R18, R21, R22) and profiles (AG1, SC1, R2, R4, R5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators import trends as T
from ..operators.impute import fit_imputer
from ..sources.tables import FACTS_SQL, facts, read_table
from .registry import query, rnd, srnd

W = f"WITH {FACTS_SQL}"

# ---------------------------------------------------------------- trends


@query("r6_yearly_trend", f"""{W}
SELECT year, {srnd('sum(amount)', 2)} AS total, {srnd('avg(amount)')} AS average,
       CAST(count(*) AS BIGINT) AS cases
FROM facts GROUP BY year""", headline=True)
def r6_yearly_trend(spark: SparkSession, sf: str) -> DataFrame:
    t = T.yearly_trend(facts(spark, sf), "year", "amount")
    return t.select("year", rnd("total", 2).alias("total"), rnd("average").alias("average"), "cases")


@query("r7_change", f"""{W}, t AS (SELECT year, sum(amount) AS total FROM facts GROUP BY year)
SELECT min(year) AS first_year, max(year) AS last_year,
       {srnd('arg_min(total, year)', 2)} AS first_total,
       {srnd('arg_max(total, year)', 2)} AS last_total,
       {srnd('(arg_max(total, year) - arg_min(total, year)) / arg_min(total, year) * 100')} AS pct_change
FROM t""")
def r7_change(spark: SparkSession, sf: str) -> DataFrame:
    ch = T.first_last_change(T.yearly_trend(facts(spark, sf), "year", "amount"))
    return ch.select("first_year", "last_year", rnd("first_total", 2).alias("first_total"),
                     rnd("last_total", 2).alias("last_total"), rnd("pct_change").alias("pct_change"))


@query("r8_monthly_avg", f"""{W}, m AS (SELECT month, avg(amount) AS average FROM facts GROUP BY month),
o AS (SELECT avg(amount) AS mu FROM facts)
SELECT month, {srnd('average')} AS average, {srnd('average - mu')} AS dev_from_mean,
       row_number() OVER (ORDER BY average DESC, month ASC) <= 3 AS is_peak
FROM m, o""")
def r8_monthly_avg(spark: SparkSession, sf: str) -> DataFrame:
    m = T.monthly_profile(facts(spark, sf), "month", "amount")
    return m.select("month", rnd("average").alias("average"),
                    rnd("dev_from_mean").alias("dev_from_mean"), "is_peak")


@query("r9_coverage", f"""{W}, c AS (SELECT legal_basis AS category, count(*) AS n FROM facts GROUP BY 1),
t AS (SELECT count(*) AS total FROM facts),
h AS (SELECT * FROM c ORDER BY n DESC, category ASC LIMIT 10)
SELECT CAST(row_number() OVER (ORDER BY n DESC, category) AS BIGINT) AS position, category,
       CAST(n AS BIGINT) AS n, {srnd('CAST(n AS DOUBLE) * 100.0 / total')} AS pct,
       {srnd('CAST(sum(n) OVER (ORDER BY n DESC, category ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) * 100.0 / total')} AS cum_pct
FROM h, t""")
def r9_coverage(spark: SparkSession, sf: str) -> DataFrame:
    c = T.coverage(facts(spark, sf), "legal_basis")
    return c.select("position", "category", "n", rnd("pct").alias("pct"), rnd("cum_pct").alias("cum_pct"))


@query("r10_counts", f"""{W}
SELECT sector AS category, CAST(count(*) AS BIGINT) AS n FROM facts GROUP BY 1""")
def r10_counts(spark: SparkSession, sf: str) -> DataFrame:
    return T.category_counts(facts(spark, sf), "sector")


@query("r11_pair_corr", f"""{W}
SELECT {srnd('corr(fines, amount)')} AS r FROM facts""")
def r11_pair_corr(spark: SparkSession, sf: str) -> DataFrame:
    return T.pair_correlation(facts(spark, sf), "fines", "amount").select(rnd("r").alias("r"))


@query("r16_density", f"""{W}
SELECT municipality, {srnd('sum(fines) / NULLIF(sum(CAST(taxpayers AS DOUBLE)), 0)')} AS density
FROM facts GROUP BY municipality""")
def r16_density(spark: SparkSession, sf: str) -> DataFrame:
    d = T.density(facts(spark, sf), "municipality", "fines", "taxpayers")
    return d.select("municipality", rnd("density").alias("density"))


@query("r17_history", f"""{W}, per AS (
  SELECT municipality, year, month, round(sum(amount), 2) AS s, count(amount) AS n
  FROM facts GROUP BY municipality, year, month)
SELECT municipality, year, month,
       {srnd('round(sum(s) OVER w, 2) / NULLIF(CAST(sum(n) OVER w AS DOUBLE), 0)')} AS prior_avg
FROM per
WINDOW w AS (PARTITION BY municipality ORDER BY year, month
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def r17_history(spark: SparkSession, sf: str) -> DataFrame:
    h = T.historical_average(facts(spark, sf), "municipality", "year", "month", "amount",
                             money_digits=2)
    return h.select("municipality", "year", "month", rnd("prior_avg").alias("prior_avg"))


@query("r18_risk", f"""{W}, o AS (SELECT avg(amount) AS mu FROM facts)
SELECT sector, {srnd('avg(amount) / max(mu)')} AS risk FROM facts, o GROUP BY sector""")
def r18_risk(spark: SparkSession, sf: str) -> DataFrame:
    r = T.risk_score(facts(spark, sf), "sector", "amount")
    return r.select("sector", rnd("risk").alias("risk"))


_DIMS = ("municipality", "legal_basis", "sector", "status", "year")


def _reconcile_sql() -> str:
    parts = [f"SELECT '{d}' AS dim, CAST(count(*) AS BIGINT) AS n_categories, CAST(sum(n) AS BIGINT) AS total "
             f"FROM (SELECT {d}, count(*) AS n FROM facts GROUP BY {d})" for d in _DIMS]
    return (f"{W}, per AS ({' UNION ALL '.join(parts)}), r AS (SELECT CAST(count(*) AS BIGINT) AS rows FROM facts)\n"
            "SELECT dim, n_categories, total, rows, total = rows AS matches FROM per, r")


@query("r21_reconcile", _reconcile_sql())
def r21_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    return P.reconcile(facts(spark, sf), _DIMS)


@query("r22_uplift", f"""{W}
SELECT {srnd('avg(CASE WHEN month IN (10, 11, 12) THEN amount END) / avg(CASE WHEN month NOT IN (10, 11, 12) THEN amount END) - 1')} AS q4_uplift,
       {srnd('avg(CASE WHEN month IN (1, 3, 5, 7, 8, 10, 12) THEN amount END) / avg(CASE WHEN month NOT IN (1, 3, 5, 7, 8, 10, 12) THEN amount END) - 1')} AS d31_uplift
FROM facts""")
def r22_uplift(spark: SparkSession, sf: str) -> DataFrame:
    u = T.uplifts(facts(spark, sf), "month", "amount")
    return u.select(rnd("q4_uplift").alias("q4_uplift"), rnd("d31_uplift").alias("d31_uplift"))


# ---------------------------------------------------------------- profiles

def orders_with_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Null fixture derived from the data (no null exists in the tables)."""
    o = read_table(spark, sf, "orders")
    return o.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("o_orderpriority"))


ORDERS_NULLS_SQL = """o AS (
  SELECT o_orderkey, o_custkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus,
         CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice END AS o_totalprice,
         o_orderdate, NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority
  FROM orders)"""

_ORDER_KINDS = (("o_orderkey", "numeric"), ("o_custkey", "numeric"), ("o_orderstatus", "string"),
                ("o_totalprice", "numeric"), ("o_orderdate", "datetime"), ("o_orderpriority", "string"))


def _null_profile_sql() -> str:
    parts = [f"""SELECT '{c}' AS column_name, '{k}' AS kind,
  CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls,
  {srnd(f'100.0 * sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / count(*)')} AS null_pct,
  CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM o""" for c, k in _ORDER_KINDS]
    return f"WITH {ORDERS_NULLS_SQL}\n" + "\nUNION ALL\n".join(parts)


@query("ag1_null_profile", _null_profile_sql())
def ag1_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    p = P.null_profile(orders_with_nulls(spark, sf))
    return p.select(F.col("column").alias("column_name"), "kind", "nulls",
                    rnd("null_pct").alias("null_pct"), "n_distinct")


@query("sc1_impute", f"""WITH {ORDERS_NULLS_SQL},
med AS (SELECT median(o_totalprice) AS m FROM o),
ms AS (SELECT o_orderstatus AS v FROM o WHERE o_orderstatus IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v ASC LIMIT 1),
mp AS (SELECT o_orderpriority AS v FROM o WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v ASC LIMIT 1)
SELECT o_orderkey, {srnd('coalesce(o_totalprice, (SELECT m FROM med))')} AS o_totalprice,
       coalesce(o_orderstatus, (SELECT v FROM ms)) AS o_orderstatus,
       coalesce(o_orderpriority, (SELECT v FROM mp)) AS o_orderpriority
FROM o""")
def sc1_impute(spark: SparkSession, sf: str) -> DataFrame:
    o = orders_with_nulls(spark, sf)
    model = fit_imputer(o, numeric=["o_totalprice"], strings=["o_orderstatus", "o_orderpriority"])
    f = model.transform(o)
    return f.select("o_orderkey", rnd("o_totalprice").alias("o_totalprice"),
                    "o_orderstatus", "o_orderpriority")


_LI_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _numeric_profile_sql() -> str:
    parts = []
    for c in _LI_NUM:
        parts.append(f"""SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n,
  {srnd(f'min({c})')} AS min, {srnd(f'max({c})')} AS max, {srnd(f'avg({c})')} AS mean,
  {srnd(f'stddev_samp({c})')} AS std, {srnd(f'skewness({c})')} AS skew,
  {srnd(f'quantile_cont({c}, 0.25)')} AS q1, {srnd(f'quantile_cont({c}, 0.75)')} AS q3,
  (SELECT CAST(count(*) AS BIGINT) FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM lineitem) q
    WHERE {c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)) AS outliers
FROM lineitem""")
    return "\nUNION ALL\n".join(parts)


@query("r4_numeric_profile", _numeric_profile_sql())
def r4_numeric_profile(spark: SparkSession, sf: str) -> DataFrame:
    p = P.numeric_profile(read_table(spark, sf, "lineitem"), _LI_NUM)
    return p.select(F.col("column").alias("column_name"), "n",
                    *[rnd(c).alias(c) for c in ("min", "max", "mean", "std", "skew", "q1", "q3")],
                    "outliers")


@query("r2_iqr_cap", """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
SELECT event_id,
  """ + srnd("least(greatest(value, a - 1.5 * (b - a)), b + 1.5 * (b - a))") + """ AS value_capped,
  CAST(value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a) AS INTEGER) AS value_is_outlier
FROM events, q""")
def r2_iqr_cap(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events")
    capped = P.cap_outliers(ev, P.iqr_fences(ev, ["value"]))
    return capped.select("event_id", rnd("value_capped").alias("value_capped"), "value_is_outlier")


@query("r5_quality_checks", """SELECT CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM events)) AS BIGINT) AS dup_rows,
  CAST(sum(CASE WHEN value = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_rows,
  CAST(sum(CASE WHEN event_id IS NULL OR ts IS NULL OR user_id IS NULL OR event_type IS NULL
                 OR value IS NULL OR props IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_rows
FROM events""")
def r5_quality_checks(spark: SparkSession, sf: str) -> DataFrame:
    return P.quality_checks(read_table(spark, sf, "events"), ["value"])
