"""Per-group statistics broadcast back to rows (AG5-AG8, WN1, WN2, JN2).

Plan shape, per key:

* one ``groupBy(key)`` computing mean / sample std / min / max / count of all
  columns (partial aggregation: a key with a third of all rows is combined
  map-side);
* one ranked pass over the long form ``(key, column, value)`` that yields
  both the exact medians and the 'min' ranks (WN1) of all columns;
* the group table is checkpointed, counted and joined back (broadcast only
  under the limit).  Null keys get null statistics (pandas drops NaN groups).

``Window.partitionBy(key)`` is deliberately not used on fact rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import number
from .encode import fold_of
from .lookup import Lookup
from .order_stats import (_RANK0, group_quantiles, interpolated, null_safe_join, quantiles_from_ranked,
                          ranked_counts, ranked_histogram, unpivot_numeric)

ALL_STATS = ("mean", "std", "min", "max", "median")


def _name(stat: str, col: str, key: str, template: str) -> str:
    return template.format(stat=stat, col=col, key=key)


def _moments(df: DataFrame, key: str, cols: Sequence[str], stats: Sequence[str],
             template: str) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_gn")]
    for c in cols:
        x = number(c)
        if "mean" in stats:
            aggs.append(F.avg(x).alias(_name("mean", c, key, template)))
        if "std" in stats:
            # sample std; a singleton group gives 0 (pandas std().fillna(0))
            aggs.append(F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias(_name("std", c, key, template)))
        if "min" in stats:
            aggs.append(F.min(x).alias(_name("min", c, key, template)))
        if "max" in stats:
            aggs.append(F.max(x).alias(_name("max", c, key, template)))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def _medians_wide(med: DataFrame, key: str, cols: Sequence[str], template: str) -> DataFrame:
    wide = med.groupBy(key).pivot("_gcol", list(cols)).agg(F.first("_gmed"))
    return wide.select(key, *[F.col(c).alias(_name("median", c, key, template)) for c in cols])


def group_table(df: DataFrame, key: str, cols: Sequence[str],
                stats: Sequence[str] = ALL_STATS, method: str = "exact",
                template: str = "{stat}_{col}_by_{key}") -> DataFrame:
    """One row per non-null key with the requested statistics of every column."""
    base = _moments(df, key, cols, stats, template)
    if "median" in stats:
        long = unpivot_numeric(df.where(F.col(key).isNotNull()), cols, [key], "_gcol", "_gval")
        med = group_quantiles(long, "_gval", [0.5], by=[key, "_gcol"], names=["_gmed"],
                              method=method)
        base = base.join(_medians_wide(med, key, cols, template), key, "left")
    return base


def add_group_stats(df: DataFrame, key: str, cols: Sequence[str],
                    stats: Sequence[str] = ALL_STATS, dev: bool = True,
                    rank_pct: bool = True, method: str = "exact",
                    template: str = "{stat}_{col}_by_{key}") -> DataFrame:
    """AG5-AG7 + WN1 + WN2 for one key: adds the reference's per-row columns.

    Medians and 'min' ranks of all columns come from ONE ranked pass over the
    long form ``(key, column, value)``; moments from one grouped aggregate.
    """
    cols = list(cols)
    need_rank = rank_pct or ("median" in stats and method == "exact")
    ranked = None
    if need_rank:
        long = unpivot_numeric(df.where(F.col(key).isNotNull()), cols, [key], "_gcol", "_gval")
        ranked = Lookup.materialise(ranked_histogram(long, "_gval", [key, "_gcol"]))
    table = _moments(df, key, cols, stats, template)
    if "median" in stats:
        if method == "exact":
            med = quantiles_from_ranked(ranked.df, "_gval", [0.5], [key, "_gcol"], ["_gmed"])
        else:
            long = unpivot_numeric(df.where(F.col(key).isNotNull()), cols, [key], "_gcol", "_gval")
            med = group_quantiles(long, "_gval", [0.5], [key, "_gcol"], ["_gmed"], method=method)
        table = table.join(_medians_wide(med, key, cols, template), key, "left")
    out = Lookup.materialise(table).join_to(df, key, "left")
    if rank_pct:
        for c in cols:
            # NaN has no rank, as null has none
            part = ranked.df.where(F.col("_gcol") == c).select(
                key, F.col("_gval").alias("_gv"), (F.col(_RANK0) + 1).alias("_grank"))
            out = ranked.part(part).join_to(
                out.withColumn("_gv", number(c)), [key, "_gv"], "left")
            out = out.withColumn(_name("rank_pct", c, key, template),
                                 F.col("_grank") / F.col("_gn")).drop("_gv", "_grank")
    if dev:
        out = out.select("*", *[(F.col(c).cast("double") - F.col(_name("mean", c, key, template)))
                                .alias(_name("dev_from_mean", c, key, template)) for c in cols])
    return out.drop("_gn")


def target_stats_leaky(df: DataFrame, key: str, target: str, method: str = "exact",
                       template: str = "target_{stat}_by_{key}") -> DataFrame:
    """AG8 parity: in-sample mean / median / std and deviation of the raw target.

    Note (F1): ``target_mean + target_dev_from_mean`` equals the target.
    """
    t = "{stat}_" + "{col}_by_{key}"
    table = group_table(df, key, [target], ("mean", "median", "std"), method, t)
    ren = {_name(s, target, key, t): template.format(stat=s, key=key)
           for s in ("mean", "median", "std")}
    table = table.select(key, *[F.col(a).alias(b) for a, b in ren.items()])
    out = Lookup.materialise(table).join_to(df, key, "left")
    return out.withColumn(template.format(stat="dev_from_mean", key=key),
                          F.col(target).cast("double") - F.col(template.format(stat="mean", key=key)))


def held_out_stats(df: DataFrame, by: Sequence[str], y: str, fold: str, folds: int) -> DataFrame:
    """``by...`` and arrays ``n, mean, std, median`` of ``y``: element f leaves fold f out, element ``folds`` leaves none.

    Moments are those of the single folds, merged; medians come from one
    histogram per ``(by, y)`` with a count for each fold: a value's rank over
    the other folds is its rank over all less its rank within the fold.  No row
    is copied.  Groups without values outside a fold have null means and
    medians there, and std 0 (as one value has).
    """
    by = list(by)
    hist = df.where(F.col(y).isNotNull()).groupBy(*by, y).agg(
        F.count(F.lit(1)).alias("_ca"), *[F.count_if(F.col(fold) == f).alias(f"_c{f}") for f in range(folds)])
    return held_out_from_ranked(df, ranked_counts(hist, y, by, ["_ca", *[f"_c{f}" for f in range(folds)]]), by, y, fold, folds)


def held_out_from_ranked(df: DataFrame, ranked: DataFrame, by: Sequence[str], y: str, fold: str, folds: int) -> DataFrame:
    """``held_out_stats`` with the histogram ranked already (columns of ``ranked_counts`` for ``_ca``, ``_c0``, ...)."""
    by = list(by)
    per = df.groupBy(*by, fold).agg(F.count(y).alias("n"), F.avg(y).alias("mean"), (F.var_pop(y) * F.count(y)).alias("m2"))
    parts = per.groupBy(*by).agg(F.collect_list(F.struct(F.col(fold).alias("f"), "n", "mean", "m2")).alias("_parts"))  # folds rows at most

    def merged(f: int):
        own = F.filter("_parts", lambda p: (p.f != f) & (p.n > 0))
        total = lambda value: F.aggregate(F.transform(own, value), F.lit(0.0), lambda acc, v: acc + v)
        n = total(lambda p: p.n.cast("double"))
        mean = F.try_divide(total(lambda p: p.n * p.mean), n)
        m2 = total(lambda p: p.m2 + p.n * (p.mean - mean) * (p.mean - mean))
        return F.struct(n.alias("n"), mean.alias("mean"), F.when(n > 1, F.sqrt(m2 / (n - 1))).otherwise(F.lit(0.0)).alias("std"))

    moments = parts.select(*by, F.array(*[merged(f) for f in range(folds + 1)]).alias("_m"))
    medians = []
    for f in range(folds):
        count, rank0, n = (F.col(f"_ca{x}") - F.col(f"_c{f}{x}") for x in ("", "_rank0", "_n"))
        medians.append(interpolated(0.5, F.col(y).cast("double"), count, rank0, n))
    medians.append(interpolated(0.5, F.col(y).cast("double"), F.col("_ca"), F.col("_ca_rank0"), F.col("_ca_n")))
    med = ranked.where(reduce(or_, [hit for hit, _ in medians])).groupBy(*by).agg(F.array(*[m for _, m in medians]).alias("median"))
    return null_safe_join(moments, med, by).select(
        *by, *[F.col(f"_m.{s}").alias(s) for s in ("n", "mean", "std")], "median")


def target_stats_oof(df: DataFrame, key: str, target: str, row_key: Sequence[str],
                     folds: int = 5, seed: int = 42,
                     template: str = "target_{stat}_by_{key}") -> DataFrame:
    """AG8 leak-safe: a row in fold f gets statistics of its group over the other folds.

    There is no deviation column here: next to the out-of-fold mean it would
    give the row's own target away (mean + deviation = target).  Rows of a
    group that lies in one fold have null statistics.
    """
    with_fold = df.withColumn("_fold", fold_of(row_key, folds, seed))
    rows = with_fold.where(F.col(key).isNotNull()).select(key, "_fold", number(target).alias("_y"))
    names = {s: template.format(stat=s, key=key) for s in ("mean", "median", "std")}
    stats = held_out_stats(rows, [key], "_y", "_fold", folds)
    table = stats.select(key, F.posexplode(F.slice(F.arrays_zip("n", *names), 1, folds)).alias("_fold", "_s")).where("_s.n > 0").select(
        key, "_fold", *[F.col(f"_s.{s}").alias(name) for s, name in names.items()])
    return Lookup.materialise(table).join_to(with_fold, [key, "_fold"], "left")
