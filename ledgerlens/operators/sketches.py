"""Mergeable sketches behind the approximate side of AG2, AG7, FT1 and R3.

``states`` makes one small binary state per group and column: a KLL sketch for
quantiles, a HyperLogLog sketch for distinct counts (Spark's own aggregates,
combined map-side).  Written once for the finest grouping, or for each new part
of the data, states merge to any coarser grouping without another pass over
the rows; ``quantiles`` and ``distinct_counts`` read them with their error bounds.
Null and NaN values are in no quantile state; null values in no distinct state.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import number
from .scale import AffineScaler

KLL_K = 400          # size of a quantile state
HLL_LG_K = 12        # 2^12 registers of a distinct state
CONFIDENCE = 0.99    # of the quantile bound


def rank_error(k: int = KLL_K) -> float:
    """Single-sided rank error of a KLL quantile, as a share of the rows, at 99 % confidence (fixed constants of the sketch)."""
    return 2.296 / k ** 0.9723


def distinct_error(lg_k: int = HLL_LG_K) -> float:
    """Three standard deviations of a merged HyperLogLog estimate, relative."""
    return 3 * 1.04 / math.sqrt(1 << lg_k)


def states(df: DataFrame, by: Sequence[str], quantiles_of: Sequence[str] = (), distinct_of: Sequence[str] = (),
           k: int = KLL_K, lg_k: int = HLL_LG_K) -> DataFrame:
    """``by..., q_{col}..., d_{col}...``: one row of states for each group."""
    aggs = [F.kll_sketch_agg_double(number(c), F.lit(k)).alias(f"q_{c}") for c in quantiles_of]
    aggs += [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"d_{c}") for c in distinct_of]
    return df.groupBy(*by).agg(*aggs)


def merged(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """States of a coarser grouping (``by``: some of the stored grouping's columns, or none)."""
    aggs = [F.kll_merge_agg_double(c).alias(c) for c in stored.columns if c.startswith("q_")]
    aggs += [F.hll_union_agg(c).alias(c) for c in stored.columns if c.startswith("d_")]
    return stored.groupBy(*by).agg(*aggs)


def quantiles(stored: DataFrame, by: Sequence[str], col: str, probs: Sequence[float], k: int = KLL_K) -> DataFrame:
    """``by..., n, q0, q1, ..., max_rank_error`` (null quantiles for a group without values)."""
    state = F.col(f"q_{col}")
    n = F.kll_sketch_get_n_double(state)
    found = [F.when(n > 0, F.kll_sketch_get_quantile_double(state, F.lit(float(p)))).alias(f"q{i}") for i, p in enumerate(probs)]
    return stored.select(*by, n.alias("n"), *found, F.lit(rank_error(k)).alias("max_rank_error"))


def distinct_counts(stored: DataFrame, by: Sequence[str], cols: Sequence[str], lg_k: int = HLL_LG_K) -> DataFrame:
    """``by..., {col}..., max_relative_error``."""
    return stored.select(*by, *[F.hll_sketch_estimate(f"d_{c}").alias(c) for c in cols], F.lit(distinct_error(lg_k)).alias("max_relative_error"))


def robust_scaler(stored: DataFrame, cols: Sequence[str], suffix: str = "") -> AffineScaler:
    """FT1 from stored states of all rows: median and IQR within the rank error; a zero IQR divides by 1."""
    whole = merged(stored, [])
    center, scale = {}, {}
    for c in cols:
        row = quantiles(whole, [], c, [0.25, 0.5, 0.75]).first()
        known = row is not None and row["q1"] is not None
        center[c] = float(row["q1"]) if known else 0.0
        scale[c] = float(row["q2"] - row["q0"]) if known and row["q2"] != row["q0"] else 1.0
    return AffineScaler(center, scale, suffix)
