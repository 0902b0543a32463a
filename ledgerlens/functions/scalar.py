"""Row-level column expressions (SC2-SC11, SC13, R14, R15, FT7).

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen.  Integers are widened to DOUBLE before
products (an INT cube overflows under ANSI mode).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's feature definitions.
RATIO_EPS = 0.001          # SC2: a / (b + 0.001)
PERCENT_ERROR_EPS = 1e-10  # SC13: 100 * |(y - p) / (y + 1e-10)|
SUMMER_MONTHS = (6, 8)     # SC10: June..August inclusive
WINTER_MONTHS = (12, 1, 2) # SC10: December, January, February


def expm1(c: str | Column) -> Column:
    """FT7 inverse: a target (or prediction) on the log1p scale back in its own units."""
    return F.expm1((F.col(c) if isinstance(c, str) else c).cast("double"))


def number(c: str | Column) -> Column:
    """The column as DOUBLE with NaN as null: statistics skip both alike (as pandas does)."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(x), x)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _d(x) -> Column:
    return _c(x).cast("double")


# SC2 / SC3 ---------------------------------------------------------------

def guarded_ratio(a, b, eps: float = RATIO_EPS) -> Column:
    """``a / (b + eps)``; a zero denominator yields NULL instead of an error."""
    return F.try_divide(_d(a), _d(b) + F.lit(eps))


def log1p(x) -> Column:
    return F.log1p(_d(x))


def sqrt(x) -> Column:
    return F.sqrt(_d(x))


# SC5 / SC6 ---------------------------------------------------------------

def power(x, k: int) -> Column:
    d = _d(x)
    out = d
    for _ in range(k - 1):
        out = out * d
    return out


def product(*xs) -> Column:
    out = _d(xs[0])
    for x in xs[1:]:
        out = out * _d(x)
    return out


# SC7 - SC11 calendar -----------------------------------------------------

def date_numeric(year, month) -> Column:
    return _d(year) + _d(month) / F.lit(12.0)


def season(month) -> Column:
    """Dec-Feb = 1, Mar-May = 2, Jun-Aug = 3, Sep-Nov = 4."""
    return (F.floor(F.pmod(_c(month).cast("bigint"), F.lit(12)) / 3) + 1).cast("int")


def quarter_of_month(month) -> Column:
    return (F.floor((_c(month).cast("bigint") - 1) / 3) + 1).cast("int")


def is_summer(month) -> Column:
    lo, hi = SUMMER_MONTHS
    m = _c(month)
    return ((m >= lo) & (m <= hi)).cast("int")


def is_winter(month) -> Column:
    """Month 12 or month <= 2 (as the reference: month 0 would count too)."""
    m = _c(month)
    return ((m == WINTER_MONTHS[0]) | (m <= WINTER_MONTHS[2])).cast("int")


def month_sin(month) -> Column:
    return F.sin(F.lit(2 * math.pi) * _d(month) / F.lit(12.0))


def month_cos(month) -> Column:
    return F.cos(F.lit(2 * math.pi) * _d(month) / F.lit(12.0))


# R14 / R15 ---------------------------------------------------------------

def month_start(year, month) -> Column:
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), F.lit(1))


def days_in_month(date_col) -> Column:
    return F.dayofmonth(F.last_day(_c(date_col)))


def quarter_sin(q) -> Column:
    return F.sin(F.lit(2 * math.pi) * _d(q) / F.lit(4.0))


def quarter_cos(q) -> Column:
    return F.cos(F.lit(2 * math.pi) * _d(q) / F.lit(4.0))


# SC12 quantile bin ------------------------------------------------------

def qcut_bin(x, edges: Sequence[float]) -> Column:
    """pandas ``qcut(labels=False)`` given distinct sorted edges.

    Right-closed bins, lowest edge included, 0-based: the number of edges
    strictly below ``x`` minus one, floored at 0.  Values outside
    ``[edges[0], edges[-1]]`` get NULL (pandas gives NaN).
    """
    if len(edges) < 2:
        return F.lit(None).cast("int")
    v = _d(x)
    # count of edges strictly below v as a sum of comparisons: plain
    # arithmetic that stays in whole-stage codegen (edges <= q + 1 literals)
    below = None
    for e in edges:
        t = (v > F.lit(float(e))).cast("int")
        below = t if below is None else below + t
    bin_ = F.greatest(below - 1, F.lit(0))
    inside = (v >= F.lit(float(edges[0]))) & (v <= F.lit(float(edges[-1])))
    return F.when(inside, bin_).cast("int")


# AG14 equal-width bin ----------------------------------------------------

def width_bin(x, lo: float, hi: float, bins: int) -> Column:
    """1-based equal-width bin over [lo, hi]; the max lands in the last bin."""
    if hi == lo:
        return F.when(_c(x).isNotNull(), F.lit(1)).cast("int")
    raw = F.floor((_d(x) - F.lit(lo)) / F.lit((hi - lo) / bins)) + 1
    return F.least(F.greatest(raw, F.lit(1)), F.lit(bins)).cast("int")


# SC13 / EV5 row errors ---------------------------------------------------

def error(y, p) -> Column:
    return _d(y) - _d(p)


def abs_error(y, p) -> Column:
    return F.abs(error(y, p))


def percent_error(y, p, eps: float = PERCENT_ERROR_EPS) -> Column:
    return F.lit(100.0) * F.abs(F.try_divide(error(y, p), _d(y) + F.lit(eps)))


# AG9 skewness ------------------------------------------------------------

def g1_from_population(skew_pop: Column, n: Column) -> Column:
    """Bias-corrected sample skewness G1 (pandas ``skew``) from Spark's g1.

    NULL for n < 3, as pandas gives NaN.
    """
    nd = n.cast("double")
    corr = F.sqrt(nd * (nd - 1)) / (nd - 2)
    return F.when(n >= 3, skew_pop * corr)
