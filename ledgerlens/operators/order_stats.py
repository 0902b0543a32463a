"""Exact order statistics that scale: medians, quartiles, quantile edges, ranks.

Spark's exact ``percentile``/``median`` aggregate keeps a value->count map
for a whole group in one buffer, and a ``Window.partitionBy(k).orderBy(v)``
puts a whole group in one task.  With one key holding a third of all rows
neither is acceptable, so every exact order statistic in this package goes
through one primitive, ``ranked_histogram``:

1. ``groupBy(by, v).count()`` -- duplicates collapse map-side (partial agg);
2. ``repartitionByRange(P, by, v)`` -- a hot group is split over many range
   partitions because the bounds are on ``(by, v)``;
3. a running count down each sorted range partition, in Arrow batches, before
   the cut (the rows are where they have to be: no window, no exchange);
4. reliable checkpoint -- fixes the partition id of every row (a lost
   executor cannot re-sample different range bounds);
5. per-partition offsets from a table of at most ``P + #groups`` rows, measured
   and broadcast under the lookups' limit.

The result is every distinct ``(group, value)`` with its exact 0-based rank
interval ``[rank0, rank0 + count)`` and the group size.  Quantiles select the
interval that contains the target rank; row ranks join back on
``(group, value)``.  ``method="approx"`` switches to ``percentile_approx``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .lookup import Lookup

_C, _PID, _RANK0, _N = "_oc", "_opid", "_orank0", "_on"


def _partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column | None:
    cond = None
    for c in cols:
        term = left[c].eqNullSafe(right[c])
        cond = term if cond is None else cond & term
    return cond


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str],
                   how: str = "left", broadcast_right: bool = False) -> DataFrame:
    """Equi-join on ``cols`` where null keys match null keys; keeps left's copies."""
    if not cols:
        raise ValueError("null_safe_join needs at least one key")
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    if broadcast_right:
        r = F.broadcast(r)
    cond = None
    for c in cols:
        term = left[c].eqNullSafe(r[f"_r_{c}"])
        cond = term if cond is None else cond & term
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in cols])


def ranked_histogram(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct ``(by..., value)`` with ``_oc`` (multiplicity), ``_orank0`` and ``_on``.

    Null and NaN values are excluded (they have no rank).  ``value`` may be any
    orderable column, including a struct used as a composite sort key.
    """
    by = list(by)
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        df = df.where(~F.isnan(value))
    hist = (df.where(F.col(value).isNotNull())
              .groupBy(*by, value).agg(F.count(F.lit(1)).alias(_C)))
    return ranked_counts(hist, value, by, [_C]).select(
        *by, value, _C, F.col(f"{_C}_rank0").alias(_RANK0), F.col(f"{_C}_n").alias(_N))


def ranked_counts(hist: DataFrame, value: str, by: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """A histogram of distinct ``(by..., value)`` with several count columns, ranked by each of them.

    Adds, for each count ``c``, ``{c}_rank0`` (the sum of ``c`` over the group's
    smaller values) and ``{c}_n`` (over the whole group).
    """
    by, counts = list(by), list(counts)
    order = [F.col(c).asc_nulls_first() for c in by] + [F.col(value).asc()]
    ranged = (hist.select(*by, value, *counts).repartitionByRange(_partitions(hist), *order).sortWithinPartitions(*order)
              .withColumns({_PID: F.spark_partition_id(), **{f"{c}_before": F.lit(0).cast("bigint") for c in counts}}))
    ranged = cut_lineage(ranged.mapInArrow(_running_counts(ranged.columns, counts), ranged.schema))
    # a group's rows in a partition follow each other: its first running count is what came before it there
    summary = ranged.groupBy(_PID, *by).agg(*[F.sum(c).alias(f"{c}_part") for c in counts],
                                            *[F.min(f"{c}_before").alias(f"{c}_start") for c in counts])
    w_off = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = Lookup.materialise(summary.select(
        _PID, *by,
        *[(F.coalesce(F.sum(f"{c}_part").over(w_off), F.lit(0)) - F.col(f"{c}_start")).alias(f"{c}_offset") for c in counts],
        *[F.sum(f"{c}_part").over(Window.partitionBy(*by)).alias(f"{c}_n") for c in counts]))
    joined = null_safe_join(ranged, offsets.df, [_PID, *by], "inner",
                            broadcast_right=offsets.small)
    return joined.select(*by, value, *counts, *[(F.col(f"{c}_offset") + F.col(f"{c}_before")).alias(f"{c}_rank0") for c in counts],
                         *[f"{c}_n" for c in counts])


def _running_counts(columns: Sequence[str], counts: Sequence[str]):
    """Arrow task: ``{c}_before`` becomes the sum of ``c`` over the partition's earlier rows."""
    places = [(list(columns).index(c), list(columns).index(f"{c}_before")) for c in counts]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = [0] * len(places)
        for batch in batches:
            for i, (count, before) in enumerate(places):
                c = batch.column(count).to_numpy()
                sums = total[i] + np.cumsum(c)
                total[i] = int(sums[-1]) if len(sums) else total[i]
                batch = batch.set_column(before, batch.schema.field(before), pa.array(sums - c, pa.int64()))
            yield batch

    return run


def _contains(rank: Column, count: Column | None = None, rank0: Column | None = None) -> Column:
    first = F.col(_RANK0) if rank0 is None else rank0
    return (first <= rank) & (rank < first + (F.col(_C) if count is None else count))


def interpolated(prob: float, value: Column, count: Column, rank0: Column, n: Column) -> tuple[Column, Column]:
    """Whether a ranked row bears on a quantile, and the quantile as an aggregate of such rows."""
    pos = (n - 1) * F.lit(float(prob))
    lo, hi = _contains(F.floor(pos), count, rank0), _contains(F.ceil(pos), count, rank0)
    low, high = F.max(F.when(lo, value)), F.max(F.when(hi, value))
    return lo | hi, low + (high - low) * F.max(pos - F.floor(pos))


def quantiles_from_ranked(ranked: DataFrame, value: str, probs: Sequence[float],
                          by: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """Linear-interpolated quantiles from a ``ranked_histogram`` (small output)."""
    by = list(by)
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    both = [interpolated(p, F.col(value).cast("double"), F.col(_C), F.col(_RANK0), F.col(_N)) for p in probs]
    return ranked.where(reduce(or_, [hit for hit, _ in both])).groupBy(*by).agg(
        *[q.alias(name) for (_, q), name in zip(both, names)])


def group_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    by: Sequence[str] = (), names: Sequence[str] | None = None,
                    method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas default) per group.

    Returns ``by...`` plus one DOUBLE column per probability.
    """
    by = list(by)
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    if len(names) != len(probs):
        raise ValueError("one name per probability")
    if method == "approx":
        x = F.col(value).cast("double")
        arr = F.percentile_approx(F.when(~F.isnan(x), x), list(probs), accuracy)
        out = df.groupBy(*by).agg(arr.alias("_oq"))
        return out.select(*by, *[F.col("_oq")[i].alias(n) for i, n in enumerate(names)])
    if method != "exact":
        raise ValueError("method must be 'exact' or 'approx'")
    return quantiles_from_ranked(ranked_histogram(df, value, by), value, probs, by, names)


def unpivot_numeric(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                    name_col: str = "column", value_col: str = "value") -> DataFrame:
    """Long form ``(by..., column, value DOUBLE)`` of several numeric columns."""
    return df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(by), list(cols), name_col, value_col)


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     method: str = "exact", accuracy: int = 10000) -> dict[str, list[float | None]]:
    """Quantiles of several columns in ONE pass (long form); small result to the driver."""
    long = unpivot_numeric(df, cols, name_col="_ocol", value_col="_oval")
    q = group_quantiles(long, "_oval", probs, by=["_ocol"], method=method, accuracy=accuracy)
    rows = {r["_ocol"]: [r[f"q{i}"] for i in range(len(probs))] for r in q.collect()}
    return {c: rows.get(c, [None] * len(probs)) for c in cols}


def group_medians(df: DataFrame, cols: Sequence[str], by: Sequence[str],
                  method: str = "exact") -> DataFrame:
    """``by...`` + ``median_{col}`` for each col, one ranked pass over the long form."""
    long = unpivot_numeric(df, cols, by, "_ocol", "_oval")
    q = group_quantiles(long, "_oval", [0.5], by=[*by, "_ocol"], names=["_omed"],
                        method=method)
    return q.groupBy(*by).pivot("_ocol", list(cols)).agg(F.first("_omed")).select(
        *by, *[F.col(c).alias(f"median_{c}") for c in cols])


def rank_min(df: DataFrame, value: str, by: Sequence[str] = (),
             out: str = "rank_min") -> DataFrame:
    """Adds the 1-based 'min' rank of ``value`` within its group (ties share the lowest).

    Null values get a null rank.  The ranked distinct table is materialised
    and joined back, broadcast only under a counted size.
    """
    by = list(by)
    ranked = ranked_histogram(df, value, by).select(
        *by, value, (F.col(_RANK0) + 1).alias(out))
    lut = Lookup.materialise(ranked)
    keys = [*by, value]
    return null_safe_join(df, lut.df, keys, "left",
                          broadcast_right=lut.small)


def qcut_edges(df: DataFrame, col: str, q: int, method: str = "exact") -> list[float]:
    """pandas ``qcut`` edges: q+1 interpolated quantiles, duplicates dropped."""
    probs = [i / q for i in range(q + 1)]
    edges = column_quantiles(df, [col], probs, method=method)[col]
    if any(e is None for e in edges):
        return []
    out: list[float] = []
    for e in edges:
        if not out or e != out[-1]:
            out.append(float(e))
    return out


def is_finite(x: float | None) -> bool:
    return x is not None and not math.isnan(x) and not math.isinf(x)
