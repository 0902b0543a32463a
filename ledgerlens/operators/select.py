"""Correlation and feature selection (AG10, AG11, PR11, TK3, TK4, TK6, R19, FS1).

A pair's correlation is over the rows where both values are there (neither
null nor NaN), whatever the other columns hold and however many there are;
a constant column yields NULL.  The matrix of any number of columns comes from
Gram matrices of the values and their masks, which Spark adds up block by block;
correlations with one target are one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import number
from ..session import cut_lineage
from .bins import fit_quantile_binner

GRAM_BUCKETS = 512         # first level of the sum of the tasks' Gram blocks
PRUNE_THRESHOLD = 0.95     # R19: |r| above which the later column is dropped
MI_BINS = 10               # FS1: quantile bins on each side
TOP_TARGET_CORR = 5        # TK3
TOP_HEATMAP = 15           # TK4
TOP_K_FEATURES = 50        # TK6


def safe_corr(x: str, y: str) -> Column:
    """Pearson r over the rows where both are present; NULL if either is constant there."""
    a, b = number(x), number(y)
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))


def target_correlations(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """AG11: ``feature, r`` (NULL for a constant feature or target)."""
    cols = [c for c in cols if c != target]
    wide = df.agg(*[safe_corr(c, target).alias(f"_r{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"_r{i}").alias("r"))
            for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("_x")).select("_x.*")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AG10 long form ``i, j, feature_i, feature_j, r`` for all ordered pairs (i != j).

    Per pair n, sums, squares and products over complete pairs.  Values are shifted by their means and scaled first (one aggregate), which
    changes no correlation and keeps the sums well conditioned.  Each task
    emits one block of k x k sums; blocks meet in buckets, then in one row.
    """
    cols = list(cols)
    k = len(cols)
    row = df.agg(*[f(number(c)) for c in cols for f in (F.avg, F.stddev_samp)]).first()
    mid = np.array([row[2 * i] or 0.0 for i in range(k)])
    wide = np.array([row[2 * i + 1] or 1.0 for i in range(k)])

    def run(batches):
        total = np.zeros((4, k, k))
        for pdf in batches:
            x = (pdf.to_numpy(dtype=float, na_value=np.nan) - mid) / wide
            m = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        yield pd.DataFrame({"b": [TaskContext.get().partitionId() % GRAM_BUCKETS], "v": [total.ravel()]})

    blocks = df.select(*[number(c).alias(f"x{i}") for i, c in enumerate(cols)]).mapInPandas(run, "b int, v array<double>")
    total = (blocks.groupBy("b").agg(Summarizer.sum(array_to_vector("v")).alias("v"))
             .agg(Summarizer.sum(F.col("v")).alias("v")).first()["v"])
    n, s, q, p = (np.zeros((4, k, k)) if total is None else total.toArray().reshape(4, k, k))
    with np.errstate(divide="ignore", invalid="ignore"):
        va, vb = q - s * s / n, (q - s * s / n).T
        r = (p - s * s.T / n) / np.sqrt(va * vb)
    # what is left of a constant's variance is rounding
    flat = (va <= 1e-12 * np.maximum(q, 1e-300)) | (vb <= 1e-12 * np.maximum(q.T, 1e-300)) | ~np.isfinite(r)
    rows = [(i, j, cols[i], cols[j], None if flat[i, j] else float(r[i, j]))
            for i in range(k) for j in range(k) if i != j]
    return df.sparkSession.createDataFrame(
        rows, "i int, j int, feature_i string, feature_j string, r double")


def lower_triangle(matrix: DataFrame) -> DataFrame:
    """PR11: keep the strictly-lower triangle (upper and diagonal masked)."""
    return matrix.where(F.col("i") > F.col("j"))


def top_by_abs(corrs: DataFrame, k: int = TOP_TARGET_CORR) -> DataFrame:
    """TK3: top-k by |r| (ties by name), nulls last."""
    return corrs.orderBy(F.abs("r").desc_nulls_last(), F.col("feature").asc()).limit(k)


def top_signed(corrs: DataFrame, k: int = TOP_HEATMAP, exclude: Sequence[str] = ()) -> DataFrame:
    """TK4: top-k by |r| (excluding some), then re-sorted by signed r descending."""
    top = (corrs.where(~F.col("feature").isin(list(exclude)) if exclude else F.lit(True))
           .orderBy(F.abs("r").desc_nulls_last(), F.col("feature").asc()).limit(k))
    return top.orderBy(F.col("r").desc_nulls_last(), F.col("feature").asc())


def prune_correlated(df: DataFrame, cols: Sequence[str],
                     threshold: float = PRUNE_THRESHOLD) -> DataFrame:
    """In order, keep a column unless its |r| with a column kept before exceeds the threshold.

    A column that goes takes no other with it.  Output ``feature, position,
    kept``; the driver holds the pairs of columns above the threshold.
    """
    cols = list(cols)
    close = {(r.i, r.j) for r in correlation_matrix(df, cols).where((F.col("j") < F.col("i")) & (F.abs("r") > threshold)).collect()}
    kept: list[int] = []
    for i in range(len(cols)):
        if not any((i, j) in close for j in kept):
            kept.append(i)
    return df.sparkSession.createDataFrame([(c, i, i in set(kept)) for i, c in enumerate(cols)], "feature string, position int, kept boolean")


def binned_mutual_information(df: DataFrame, cols: Sequence[str], target: str,
                              bins: int = MI_BINS, method: str = "exact") -> DataFrame:
    """FS1: MI (nats) between the quantile bin of each feature and of the target.

    Edges of all columns come from one ranked pass.  The joint counts of every feature
    come from one more: each task bins its rows by the edges and emits its counts.
    """
    cols = [c for c in cols if c != target]
    binner = fit_quantile_binner(df, [*cols, target], q=bins, method=method)
    edges = [np.array(binner.edges[c], float) for c in (target, *cols)]
    side = max(len(e) for e in edges) + 1

    def run(batches):
        total = np.zeros((len(cols), side * side), np.int64)
        for batch in batches:
            binned = []
            for i, e in enumerate(edges):
                v = batch.column(i).to_numpy(zero_copy_only=False).astype(float)   # a null is NaN, and in no bin
                inside = (v >= e[0]) & (v <= e[-1]) if len(e) > 1 else np.zeros(len(v), bool)
                binned.append((inside, np.maximum(np.searchsorted(e, v) - 1, 0)))
            for f, (inside, bx) in enumerate(binned[1:]):
                both = inside & binned[0][0]
                total[f] += np.bincount(bx[both] * side + binned[0][1][both], minlength=side * side)
        f, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([cols[i] for i in f], pa.string()), pa.array(cell // side, pa.int32()),
                                          pa.array(cell % side, pa.int32()), pa.array(total[f, cell])], names=["feature", "_bx", "_by", "_nxy"])

    values = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate((target, *cols))])
    joint = values.mapInArrow(run, "feature string, _bx int, _by int, _nxy bigint").groupBy("feature", "_bx", "_by").agg(F.sum("_nxy").alias("_nxy"))
    joint = cut_lineage(joint)   # at most features x bins x bins rows, read four times
    fx = joint.groupBy("feature", "_bx").agg(F.sum("_nxy").alias("_nx"))
    fy = joint.groupBy("feature", "_by").agg(F.sum("_nxy").alias("_ny"))
    ft = joint.groupBy("feature").agg(F.sum("_nxy").alias("_nt"))
    cells = joint.join(fx, ["feature", "_bx"]).join(fy, ["feature", "_by"]).join(ft, "feature")
    term = (F.col("_nxy") / F.col("_nt")) * F.log(
        (F.col("_nxy") * F.col("_nt")) / (F.col("_nx") * F.col("_ny")))
    mi = cells.groupBy("feature").agg(F.sum(term).alias("mi"))
    return df.sparkSession.createDataFrame([(c,) for c in cols], "feature string").join(
        mi, "feature", "left").select("feature", F.coalesce("mi", F.lit(0.0)).alias("mi"))


def select_k_best(scores: DataFrame, k: int = TOP_K_FEATURES, score: str = "mi") -> DataFrame:
    """TK6: top ``min(k, n)`` features by score (ties by name)."""
    return scores.orderBy(F.col(score).desc_nulls_last(), F.col("feature").asc()).limit(k)
