"""Binning: SC12 quantile bins, AG14 equal-width histogram, AG15 automatic bins and Gaussian KDE.

Edges and grids are small driver-side numbers fitted with one pass; applying
them is a projection with literal arrays.  The KDE evaluates the exact
kernel sum over every row at each grid point as G aggregate expressions in a
single pass -- no join of rows with the grid.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import number, qcut_bin, width_bin
from .order_stats import column_quantiles

HIST_BINS = 30   # AG14: the reference's chart histograms use 30 bins
KDE_GRID = 50    # AG15: evaluation points of the density curve
KDE_BINS = 4096  # AG15: bins of the binned density curve


@dataclass
class QuantileBinner:
    """SC12 fitted edges per column (pandas ``qcut(q, labels=False, duplicates='drop')``)."""

    edges: dict[str, list[float]]
    suffix: str = "_qbin"

    def bin_col(self, col: str):
        return qcut_bin(col, self.edges[col])

    def transform(self, df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
        names = names or {}
        return df.select("*", *[self.bin_col(c).alias(names.get(c, f"{c}{self.suffix}"))
                                for c in self.edges])


def fit_quantile_binner(df: DataFrame, cols: Sequence[str], q: int = 10,
                        method: str = "exact", suffix: str = "_qbin") -> QuantileBinner:
    probs = [i / q for i in range(q + 1)]
    qs = column_quantiles(df, cols, probs, method=method)
    edges = {}
    for c in cols:
        vals = qs[c]
        if any(v is None for v in vals):
            edges[c] = []
            continue
        uniq: list[float] = []
        for v in vals:
            if not uniq or v != uniq[-1]:
                uniq.append(float(v))
        edges[c] = uniq
    return QuantileBinner(edges, suffix)


def value_range(df: DataFrame, cols: Sequence[str]) -> tuple[float | None, float | None]:
    """AG13: min and max over the union of several columns."""
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(c).cast("double")), F.max(F.col(c).cast("double"))]
    row = df.agg(*aggs).first()
    lows = [row[2 * i] for i in range(len(cols)) if row[2 * i] is not None]
    highs = [row[2 * i + 1] for i in range(len(cols)) if row[2 * i + 1] is not None]
    return (min(lows) if lows else None, max(highs) if highs else None)


def range_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AG13 as a one-row DataFrame ``lo, hi``."""
    return df.agg(F.least(*[F.min(F.col(c).cast("double")) for c in cols]).alias("lo"),
                  F.greatest(*[F.max(F.col(c).cast("double")) for c in cols]).alias("hi"))


def histogram(df: DataFrame, col: str, bins: int = HIST_BINS,
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """AG14: ``bin (1-based), lo, hi, n`` for every bin, empty bins included.

    The last bin is closed (the maximum lands in it).
    """
    if lo is None or hi is None:
        lo, hi = value_range(df, [col])
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, n bigint")
    width = (hi - lo) / bins if hi != lo else 0.0
    counts = (df.where(F.col(col).isNotNull())
                .groupBy(width_bin(col, lo, hi, bins).alias("bin"))
                .agg(F.count(F.lit(1)).alias("_n")))
    grid = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    # ``counts`` has at most ``bins`` rows: a proven bound
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lo"),
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("hi"),
        F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("n"))


def auto_bin_count(n: int, lo: float, hi: float, q1: float, q3: float) -> int:
    """AG15: bins by the narrower of the Freedman-Diaconis and Sturges widths (the first only if the IQR isn't 0)."""
    if hi == lo:
        return 1
    width = (hi - lo) / (math.log2(n) + 1)
    fd = 2 * (q3 - q1) / n ** (1 / 3)
    if fd > 0:
        width = min(width, fd)
    return max(1, math.ceil((hi - lo) / width))


def auto_histogram(df: DataFrame, col: str, method: str = "exact") -> DataFrame:
    """AG15: ``histogram`` with as many bins as range, IQR and row count ask for; null and NaN values don't count."""
    rows = df.select(number(col).alias(col)).where(F.col(col).isNotNull())
    q1, q3 = column_quantiles(rows, [col], [0.25, 0.75], method=method)[col]
    lo, hi = value_range(rows, [col])
    if lo is None:
        return histogram(rows, col, 1)
    return histogram(rows, col, auto_bin_count(rows.count(), lo, hi, q1, q3), lo, hi)


def kde_binned(df: DataFrame, cols: Sequence[str], grid: int = KDE_GRID, bins: int = KDE_BINS) -> DataFrame:
    """AG15 for many columns from one pass: ``column, point, x, density, max_error``.

    Values are counted in ``bins`` equal bins a column, and each bin's count
    stands at its middle, so that the work after the pass is columns x grid x
    bins whatever the number of rows.  A value is at most half a bin away from
    its place, and the kernel's slope is at most exp(-1/2) / (h^2 sqrt(2 pi)):
    their product is ``max_error``.  Columns that are constant or have fewer
    than two values have no rows.
    """
    cols = list(cols)
    cells = F.array(*[F.struct(F.lit(i).alias("i"), number(c).alias("v")) for i, c in enumerate(cols)])
    aggs = [f(number(c)).alias(f"{name}{i}") for i, c in enumerate(cols)
            for name, f in (("n", F.count), ("sd", F.stddev_samp), ("lo", F.min), ("hi", F.max))]
    row = df.agg(*aggs).first()
    known = [(i, c, row[f"n{i}"], row[f"sd{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)
             if row[f"sd{i}"] and row[f"hi{i}"] > row[f"lo{i}"]]
    spark = df.sparkSession
    schema = "i int, column string, n bigint, h double, lo double, width double, step double"
    table = spark.createDataFrame([(i, c, n, sd * n ** -0.2, lo, (hi - lo) / bins, (hi - lo) / max(1, grid - 1))
                                   for i, c, n, sd, lo, hi in known], schema)
    place = F.least(F.floor((F.col("v") - F.col("lo")) / F.col("width")), F.lit(bins - 1))
    counts = (df.select(F.explode(cells).alias("_c")).select("_c.*").where("v is not null")
              .join(F.broadcast(table.select("i", "lo", "width")), "i").groupBy("i", place.alias("bin")).agg(F.count(F.lit(1)).alias("c")))
    points = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point")).withColumn("x", F.col("lo") + F.col("point") * F.col("step"))
    # columns x grid points meet at most columns x bins counts
    z = (F.col("x") - F.col("lo") - (F.col("bin") + 0.5) * F.col("width")) / F.col("h")
    sums = F.broadcast(points).join(counts, "i").groupBy("column", "point", "x", "n", "h", "width").agg(
        F.sum(F.col("c") * F.exp(-z * z / 2)).alias("s"))
    root = F.lit(math.sqrt(2 * math.pi))
    return sums.select("column", "point", "x", (F.col("s") / (F.col("n") * F.col("h") * root)).alias("density"),
                       (F.col("width") / 2 * math.exp(-0.5) / (F.col("h") * F.col("h") * root)).alias("max_error"))


def kde(df: DataFrame, col: str, grid: int = KDE_GRID,
        bandwidth: float | None = None) -> DataFrame:
    """AG15: Gaussian KDE on an even grid over [min, max] (Scott's rule by default).

    ``density(x) = sum_i exp(-(x - x_i)^2 / (2 h^2)) / (n h sqrt(2 pi))`` with
    ``h = std_sample * n^(-1/5)``.  Output ``point, x, density``.
    """
    x = F.col(col).cast("double")
    row = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"),
                 F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    n, sd, lo, hi = row["n"], row["sd"], row["lo"], row["hi"]
    spark = df.sparkSession
    if not n or sd is None or sd == 0:
        return spark.createDataFrame([], "point int, x double, density double")
    h = bandwidth if bandwidth is not None else sd * n ** (-1.0 / 5.0)
    step = (hi - lo) / (grid - 1) if grid > 1 else 0.0
    points = [lo + i * step for i in range(grid)]
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    sums = df.agg(*[F.sum(F.exp(-((x - F.lit(p)) * (x - F.lit(p))) / F.lit(2 * h * h)))
                    .alias(f"_k{i}") for i, p in enumerate(points)])
    rows = [F.struct(F.lit(i).alias("point"), F.lit(p).alias("x"),
                     (F.col(f"_k{i}") * F.lit(norm)).alias("density"))
            for i, p in enumerate(points)]
    return sums.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
