"""Trend and category tables.

All are grouped aggregates over the fact rows (partial aggregation first);
running sums and rankings run on the already-aggregated small tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .select import safe_corr

TOP_CATEGORIES = 10   # R9: the coverage table lists the top 10
PEAK_MONTHS = 3       # R8
Q4_MONTHS = (10, 11, 12)
LONG_MONTHS = (1, 3, 5, 7, 8, 10, 12)   # R22: months with 31 days


def yearly_trend(df: DataFrame, year: str, target: str) -> DataFrame:
    """``year, total, average, cases``."""
    y = F.col(target).cast("double")
    return df.groupBy(F.col(year).cast("bigint").alias("year")).agg(
        F.sum(y).alias("total"), F.avg(y).alias("average"),
        F.count(F.lit(1)).cast("bigint").alias("cases"))


def first_last_change(trend: DataFrame) -> DataFrame:
    """Change of the total from the first to the last year, in percent."""
    return trend.agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.min_by("total", "year").alias("first_total"),
        F.max_by("total", "year").alias("last_total"),
    ).select("*", (F.try_divide(F.col("last_total") - F.col("first_total"),
                                F.col("first_total")) * 100).alias("pct_change"))


def monthly_profile(df: DataFrame, month: str, target: str,
                    peaks: int = PEAK_MONTHS) -> DataFrame:
    """``month, average, dev_from_mean, is_peak`` (overall mean of all rows, from the months' sums)."""
    y = F.col(target).cast("double")
    per = df.groupBy(F.col(month).cast("bigint").alias("month")).agg(
        F.avg(y).alias("average"), F.sum(y).alias("_s"), F.count(y).alias("_c"))
    w = Window.orderBy(F.col("average").desc(), F.col("month").asc())
    every = Window.partitionBy()   # over the grouped rows, one for each month
    overall = F.try_divide(F.sum("_s").over(every), F.sum("_c").over(every))
    return per.select("month", "average",
                      (F.col("average") - overall).alias("dev_from_mean"),
                      (F.row_number().over(w) <= peaks).alias("is_peak"))


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """``category, n``."""
    return df.groupBy(F.col(col).alias("category")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def coverage(df: DataFrame, col: str, top: int = TOP_CATEGORIES) -> DataFrame:
    """Top-N categories by count with share and cumulative share of all rows (%)."""
    counts = cut_lineage(category_counts(df, col))
    total = counts.agg(F.sum("n").alias("_total"))   # one row; the grouped rows stay spread
    head = counts.join(F.broadcast(total)).orderBy(F.col("n").desc(), F.col("category").asc()).limit(top)
    w = Window.orderBy(F.col("n").desc(), F.col("category").asc())
    return head.select(
        F.row_number().over(w).cast("bigint").alias("position"), "category", "n",
        (F.col("n") * 100.0 / F.col("_total")).alias("pct"),
        (F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)) * 100.0 / F.col("_total"))
        .alias("cum_pct"))


def pair_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r of two columns over their complete pairs (NULL when either is constant)."""
    return df.agg(safe_corr(x, y).alias("r"))


def density(df: DataFrame, key: str, numerator: str, denominator: str) -> DataFrame:
    """Per group ``sum(numerator) / sum(denominator)``."""
    return df.groupBy(key).agg(
        F.sum(F.col(numerator).cast("double")).alias("_num"),
        F.sum(F.col(denominator).cast("double")).alias("_den"),
    ).select(key, F.try_divide("_num", "_den").alias("density"))


def historical_average(df: DataFrame, key: str, year: str, month: str,
                       target: str, money_digits: int | None = None) -> DataFrame:
    """Per group and month, the average target over all *earlier* months.

    Rows are pre-aggregated to ``(key, year, month)`` (sum, count) and the
    running sums run over that small table per key.  ``money_digits`` rounds
    the sums (e.g. to cents) so the result does not depend on addition order.
    """
    y = F.col(target).cast("double")

    def money(c):
        return c if money_digits is None else F.round(c, money_digits)

    per = df.groupBy(key, F.col(year).cast("bigint").alias("year"),
                     F.col(month).cast("bigint").alias("month")).agg(
        money(F.sum(y)).alias("_s"), F.count(y).alias("_n"))
    w = (Window.partitionBy(key).orderBy("year", "month")
         .rowsBetween(Window.unboundedPreceding, -1))
    return per.select(key, "year", "month",
                      F.try_divide(money(F.sum("_s").over(w)), F.sum("_n").over(w)).alias("prior_avg"))


def risk_score(df: DataFrame, key: str, target: str) -> DataFrame:
    """Group mean of the target divided by the overall mean."""
    y = F.col(target).cast("double")
    per = cut_lineage(df.groupBy(key).agg(F.avg(y).alias("_m"), F.sum(y).alias("_s"), F.count(y).alias("_c")))
    overall = per.agg(F.try_divide(F.sum("_s"), F.sum("_c")).alias("_o"))   # one row
    return per.join(F.broadcast(overall)).select(key, F.try_divide("_m", "_o").alias("risk"))


def conditional_uplift(df: DataFrame, target: str, cond, name: str) -> F.Column:
    """R22 expression: ``avg(y | cond) / avg(y | not cond) - 1``."""
    y = F.col(target).cast("double")
    return (F.try_divide(F.avg(F.when(cond, y)), F.avg(F.when(~cond, y))) - 1).alias(name)


def uplifts(df: DataFrame, month: str, target: str,
            q4: Sequence[int] = Q4_MONTHS, long_months: Sequence[int] = LONG_MONTHS) -> DataFrame:
    """Q4 vs rest and 31-day months vs rest, in one aggregate."""
    m = F.col(month)
    return df.agg(conditional_uplift(df, target, m.isin(list(q4)), "q4_uplift"),
                  conditional_uplift(df, target, m.isin(list(long_months)), "d31_uplift"))
