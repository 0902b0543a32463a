"""Categorical encoders (EN1 target, EN2 frequency, EN3/WN3 label, R12 one-hot).

Every encoder fits a small per-category table with one grouped aggregate
(partial aggregation, so a hot category costs nothing extra), materialises it
with a reliable checkpoint and joins it back -- broadcast only under a counted
row limit (``Lookup``).

Target encoding defaults to **out-of-fold** fitting (each row's encoding
never sees its own target); ``leaky=True`` reproduces the in-sample parity
behaviour.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import Lookup
from .order_stats import ranked_histogram

# Smoothing defaults of the public target-encoder library the
# reference calls (min_samples_leaf=20, smoothing=10; older releases used 1/1.0).
TE_MIN_SAMPLES_LEAF = 20
TE_SMOOTHING = 10.0
M_ESTIMATE_M = 10.0


def stable_hash(cols: Sequence[str], seed: int = 42) -> Column:
    """Non-negative BIGINT from the first 8 hex digits of md5('k1|k2|...|seed').

    Identical in DuckDB: ``('0x' || substr(md5(...), 1, 8))::BIGINT``.
    """
    parts = [F.col(c).cast("string") for c in cols] + [F.lit(str(seed))]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def fold_of(cols: Sequence[str], k: int, seed: int = 42) -> Column:
    return F.pmod(stable_hash(cols, seed), F.lit(k)).cast("int")


def _blend(n: Column, mean: Column, prior: Column, mode: str, min_samples_leaf: float,
           smoothing: float, m: float, singleton_to_prior: bool) -> Column:
    if mode == "sigmoid":
        s = F.lit(1.0) / (F.lit(1.0) + F.exp(-(n.cast("double") - F.lit(float(min_samples_leaf)))
                                            / F.lit(float(smoothing))))
        enc = prior * (F.lit(1.0) - s) + mean * s
        if singleton_to_prior:
            enc = F.when(n == 1, prior).otherwise(enc)
        return enc
    if mode == "m_estimate":
        return (n * mean + F.lit(float(m)) * prior) / (n + F.lit(float(m)))
    raise ValueError("mode must be 'sigmoid' or 'm_estimate'")


@dataclass
class TargetEncoderModel:
    cols: list[str]
    prior: float
    tables: dict[str, Lookup]
    suffix: str = "_te"
    inplace: bool = False

    def out_name(self, c: str) -> str:
        return c if self.inplace else f"{c}{self.suffix}"

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.cols:
            lut = self.tables[c]
            out = lut.join_to(out, c, "left")
            enc = F.coalesce(F.col("_te_enc"), F.lit(self.prior))
            keep = [x for x in out.columns if x not in ("_te_enc",)]
            if self.inplace:
                out = out.select(*[enc.alias(c) if x == c else F.col(x) for x in keep])
            else:
                out = out.select(*keep, enc.alias(self.out_name(c)))
        return out


def fit_target_encoder(df: DataFrame, cols: Sequence[str], target: str,
                       mode: str = "sigmoid", min_samples_leaf: float = TE_MIN_SAMPLES_LEAF,
                       smoothing: float = TE_SMOOTHING, m: float = M_ESTIMATE_M,
                       singleton_to_prior: bool = True, inplace: bool = False,
                       suffix: str = "_te") -> TargetEncoderModel:
    """EN1 (in-sample fit): per category ``n, mean``; unseen/null -> prior."""
    y = F.col(target).cast("double")
    prior = df.agg(F.avg(y)).first()[0]
    prior = float(prior) if prior is not None else 0.0
    tables = {}
    for c in cols:
        stats = df.where(F.col(c).isNotNull()).groupBy(c).agg(
            F.count(y).alias("_n"), F.avg(y).alias("_mean"))
        enc = _blend(F.col("_n"), F.col("_mean"), F.lit(prior), mode, min_samples_leaf,
                     smoothing, m, singleton_to_prior)
        tables[c] = Lookup.materialise(stats.select(c, enc.alias("_te_enc")))
    return TargetEncoderModel(list(cols), prior, tables, suffix, inplace)


def target_encode_oof(df: DataFrame, cols: Sequence[str], target: str, key: Sequence[str],
                      folds: int = 5, seed: int = 42, mode: str = "sigmoid",
                      min_samples_leaf: float = TE_MIN_SAMPLES_LEAF,
                      smoothing: float = TE_SMOOTHING, m: float = M_ESTIMATE_M,
                      singleton_to_prior: bool = True, suffix: str = "_te") -> DataFrame:
    """EN1 leak-safe: a row in fold f is encoded with statistics of the other folds.

    Sums are subtractable, so this is ``groupBy(cat, fold)`` once, totals per
    category, and ``total - fold`` -- no row is exploded.
    """
    y = F.col(target).cast("double")
    with_fold = df.withColumn("_fold", fold_of(key, folds, seed))
    fold_tot = with_fold.groupBy("_fold").agg(F.count(y).alias("_fn"), F.sum(y).alias("_fs"))
    all_row = fold_tot.agg(F.sum("_fn").alias("n"), F.sum("_fs").alias("s")).first()
    n_all, s_all = (all_row["n"] or 0), (all_row["s"] or 0.0)
    priors = Lookup.materialise(fold_tot.select(
        "_fold", F.try_divide(F.lit(float(s_all)) - F.col("_fs"),
                              F.lit(float(n_all)) - F.col("_fn")).alias("_prior")))
    out = priors.join_to(with_fold, "_fold", "left")
    for c in cols:
        per = with_fold.where(F.col(c).isNotNull()).groupBy(c, "_fold").agg(
            F.count(y).alias("_cn"), F.sum(y).alias("_cs"))
        tot = per.groupBy(c).agg(F.sum("_cn").alias("_tn"), F.sum("_cs").alias("_ts"))
        # one row per (category, fold) present in the data; folds where the
        # category is absent use the category total (it has no held-out rows)
        stats = Lookup.materialise(per.join(tot, c).select(
            c, "_fold", (F.col("_tn") - F.col("_cn")).alias("_on"),
            F.try_divide(F.col("_ts") - F.col("_cs"), F.col("_tn") - F.col("_cn")).alias("_om")))
        out = stats.join_to(out, [c, "_fold"], "left")
        prior = F.col("_prior")
        enc = _blend(F.col("_on"), F.col("_om"), prior, mode, min_samples_leaf, smoothing, m,
                     singleton_to_prior)
        enc = F.when(F.col("_on").isNull() | (F.col("_on") == 0), prior).otherwise(enc)
        out = out.withColumn(f"{c}{suffix}", enc).drop("_on", "_om")
    return out.drop("_prior")


@dataclass
class FrequencyEncoderModel:
    tables: dict[str, Lookup] = field(default_factory=dict)
    suffix: str = "_freq"

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, lut in self.tables.items():
            out = lut.join_to(out, c, "left").withColumnRenamed("_freq", f"{c}{self.suffix}")
        return out


def fit_frequency_encoder(df: DataFrame, cols: Sequence[str],
                          suffix: str = "_freq") -> FrequencyEncoderModel:
    """EN2: relative frequency of each value (nulls excluded; null -> null)."""
    tables = {}
    totals = df.agg(*[F.count(F.col(c)).alias(c) for c in cols]).first()
    for c in cols:
        total = totals[c]
        counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        tables[c] = Lookup.materialise(counts.select(
            c, (F.col("_n") / F.lit(float(total))).alias("_freq")))
    return FrequencyEncoderModel(tables, suffix)


@dataclass
class LabelEncoderModel:
    tables: dict[str, Lookup] = field(default_factory=dict)
    suffix: str = "_label"

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, lut in self.tables.items():
            out = lut.join_to(out, c, "left").withColumnRenamed("_label", f"{c}{self.suffix}")
        return out

    def mapping(self, col: str) -> DataFrame:
        return self.tables[col].df.withColumnRenamed("_label", "label")


def fit_label_encoder(df: DataFrame, cols: Sequence[str],
                      suffix: str = "_label") -> LabelEncoderModel:
    """EN3 / WN3: 0-based position of each distinct string in code-point order.

    The rank over distinct values goes through the range-partitioned
    ``ranked_histogram`` (no global window in one task).
    """
    tables = {}
    for c in cols:
        distinct = df.select(F.col(c).cast("string").alias(c)).where(F.col(c).isNotNull()).distinct()
        ranked = ranked_histogram(distinct, c)
        tables[c] = Lookup.materialise(ranked.select(c, F.col("_orank0").cast("int").alias("_label")))
    return LabelEncoderModel(tables, suffix)


def one_hot(df: DataFrame, col: str, values: Sequence[str] | None = None,
            max_values: int = 64, prefix: str | None = None) -> DataFrame:
    """0/1 indicator per value of a low-cardinality column (null -> all 0).

    Unknown values are discovered with a bounded distinct query: more than
    ``max_values`` distinct values is an error, not a silent cap.
    """
    prefix = prefix or col
    if values is None:
        found = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct()
                 .limit(max_values + 1).collect()]
        if len(found) > max_values:
            raise ValueError(f"{col} has more than {max_values} values; not low-cardinality")
        values = sorted(found)
    return df.select("*", *[
        F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{prefix}_{v}")
        for v in values])


def label_roundtrip(df: DataFrame, col: str, model: LabelEncoderModel) -> DataFrame:
    """Every row must get a label; labels span 0..k-1."""
    enc = model.transform(df.select(col))
    lab = F.col(f"{col}{model.suffix}")
    return enc.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_if(lab.isNull() & F.col(col).isNotNull()).cast("bigint").alias("n_unlabeled"),
        F.min(lab).cast("bigint").alias("min_label"),
        F.max(lab).cast("bigint").alias("max_label"),
        F.count_distinct(lab).cast("bigint").alias("n_labels"))
