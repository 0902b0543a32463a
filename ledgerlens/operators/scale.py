"""Scalers (FT1 robust, FT2 standard, R13 min-max) as fitted projections.

Fitting is one aggregate (or one ranked pass for quartiles over all columns
in long form); the model holds driver scalars and ``transform`` is a single
``select`` -- no per-column ``withColumn`` chain, no vector UDF.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order_stats import column_quantiles


@dataclass
class AffineScaler:
    """``(x - center) / scale`` per column; the output replaces the column."""

    center: dict[str, float]
    scale: dict[str, float]
    suffix: str = ""

    def expr(self, c: str):
        return (F.col(c).cast("double") - F.lit(self.center[c])) / F.lit(self.scale[c])

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.suffix:
            return df.select(*[self.expr(c).alias(c) if c in self.center else F.col(c)
                               for c in df.columns])
        return df.select("*", *[self.expr(c).alias(f"{c}{self.suffix}") for c in self.center])


def _nonzero(v: float | None) -> float:
    return 1.0 if v is None or v == 0 else float(v)


def fit_robust_scaler(df: DataFrame, cols: Sequence[str], method: str = "exact",
                      suffix: str = "") -> AffineScaler:
    """FT1: median and IQR (Q3 - Q1); a zero IQR divides by 1."""
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75], method=method)
    center = {c: float(q[c][1]) if q[c][1] is not None else 0.0 for c in cols}
    scale = {c: _nonzero(None if q[c][0] is None else q[c][2] - q[c][0]) for c in cols}
    return AffineScaler(center, scale, suffix)


def fit_standard_scaler(df: DataFrame, cols: Sequence[str], suffix: str = "") -> AffineScaler:
    """FT2: mean and **population** std; a zero std divides by 1."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    center = {c: float(row[f"m_{c}"] or 0.0) for c in cols}
    scale = {c: _nonzero(row[f"s_{c}"]) for c in cols}
    return AffineScaler(center, scale, suffix)


def fit_minmax_scaler(df: DataFrame, cols: Sequence[str], suffix: str = "") -> AffineScaler:
    """To [0, 1]; a constant column maps to 0."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"lo_{c}"), F.max(x).alias(f"hi_{c}")]
    row = df.agg(*aggs).first()
    center = {c: float(row[f"lo_{c}"] or 0.0) for c in cols}
    scale = {c: _nonzero(None if row[f"lo_{c}"] is None else row[f"hi_{c}"] - row[f"lo_{c}"])
             for c in cols}
    return AffineScaler(center, scale, suffix)
