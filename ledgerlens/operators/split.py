"""Deterministic splits (SP1 stratified, SP2 hold-out, SP3 k-fold).

Membership is a function of a stable md5 hash of the row key, so a split is
reproducible under re-partitioning, retries and executor loss (``rand()`` is
not).  The stratified split is exact per stratum: the test rows of a stratum
are the ``round(test_size * n)`` smallest ``(hash, key)`` values.  Counts per
hash prefix (at most 65,536 a stratum, combined before the shuffle) say in which
prefix the cut falls, and only that prefix's rows are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bins import fit_quantile_binner
from .encode import fold_of, stable_hash
from .lookup import Lookup
from .order_stats import _C, _RANK0, ranked_histogram

TEST_SIZE = 0.2     # SP1 / SP2
STRATA_BINS = 5     # SP1: quintiles of the target
KFOLDS = 3          # SP3
SEED = 42
PREFIX_SHIFT = 16   # of the 32 hash bits, the upper 16 are the prefix


def holdout_flag(key: Sequence[str], test_pct: int = int(TEST_SIZE * 100),
                 seed: int = SEED) -> Column:
    """SP2: 1 for the hold-out rows (``hash mod 100 < pct``), else 0."""
    return (F.pmod(stable_hash(key, seed), F.lit(100)) < test_pct).cast("int")


def kfold(key: Sequence[str], k: int = KFOLDS, seed: int = SEED) -> Column:
    """SP3: fold id in ``[0, k)``; usable as ``CrossValidator(foldCol=...)``."""
    return fold_of(key, k, seed)


def stratified_split(df: DataFrame, target: str, key: Sequence[str],
                     test_size: float = TEST_SIZE, q: int = STRATA_BINS, seed: int = SEED,
                     method: str = "exact") -> DataFrame:
    """SP1: adds ``stratum`` (qcut of target) and ``is_test`` (0/1).

    Per stratum exactly ``round(test_size * n_stratum)`` rows are test rows.
    """
    binner = fit_quantile_binner(df, [target], q=q, method=method)
    order = F.struct(stable_hash(key, seed).alias("h"),
                     *[F.col(c).alias(f"k{i}") for i, c in enumerate(key)])
    tagged = df.select("*", binner.bin_col(target).alias("stratum"), order.alias("_sord"))
    tagged = tagged.withColumn("_sp", F.shiftright(F.col("_sord.h").cast("bigint"), PREFIX_SHIFT))
    counts = tagged.groupBy("stratum", "_sp").agg(F.count(F.lit(1)).alias("_c"))
    own = Window.partitionBy("stratum")
    counts = counts.select("stratum", "_sp", "_c", F.sum("_c").over(own).alias("_n"), F.coalesce(F.sum("_c").over(
        own.orderBy("_sp").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    n_test = F.round(F.col("_n") * F.lit(float(test_size)))
    # one row per stratum: the prefix that holds the cut, and how many of its rows are test rows
    lut = Lookup.materialise(
        counts.where((F.col("_before") < n_test) & (n_test <= F.col("_before") + F.col("_c")))
              .select("stratum", F.col("_sp").alias("_pcut"), (n_test - F.col("_before")).alias("_need")))
    near = lut.join_to(tagged.select("stratum", "_sp", "_sord"), "stratum", "inner").where("_sp = _pcut")
    ranked = ranked_histogram(near.select("stratum", "_sord"), "_sord", ["stratum"])
    cut = lut.join_to(ranked, "stratum", "inner").where(
        (F.col(_RANK0) < F.col("_need")) & (F.col("_need") <= F.col(_RANK0) + F.col(_C)))
    lut = Lookup.materialise(cut.select("stratum", "_pcut", F.col("_sord").alias("_scut")))
    out = lut.join_to(tagged, "stratum", "left")
    flag = (F.col("_sp") < F.col("_pcut")) | ((F.col("_sp") == F.col("_pcut")) & (F.col("_sord") <= F.col("_scut")))
    return out.withColumn("is_test", F.coalesce(flag.cast("int"), F.lit(0))).drop("_sord", "_sp", "_scut", "_pcut")
