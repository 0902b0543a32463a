"""Scoring, comparison and explanation (AG12, AG13, EV1-EV6, TK5, MD4, IMP1, EV4).

Predictions stay a DataFrame ``(model, split, y, p, ...)``; every metric table
is one grouped aggregate over it.  R² uses the stable ``var_pop`` aggregate
for the total sum of squares (no sum-of-squares cancellation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S

R2_TARGET = 0.9            # EV6: the reference's goal
BLEND_WEIGHT = 0.7         # MD4: weight of the first model
PERM_REPEATS = 5           # EV4
PERM_BUCKET_ROWS = 1_000_000  # EV4: rows per hash bucket a permutation stays within


def r2_expr(sse: Column, sst: Column) -> Column:
    """1 - SSE/SST; a constant target gives 1 when perfect, else 0."""
    return F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))) \
            .otherwise(F.lit(1.0) - sse / sst)


def regression_metrics(pred: DataFrame, label: str = "y", prediction: str = "p",
                       by: Sequence[str] = ("model", "split")) -> DataFrame:
    """EV1 / EV2 / AG12: ``by..., n, mae, rmse, r2``."""
    e = F.col(label).cast("double") - F.col(prediction).cast("double")
    agg = pred.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("_mse"),
        F.sum(e * e).alias("_sse"),
        (F.var_pop(F.col(label).cast("double")) * F.count(F.lit(1))).alias("_sst"))
    return agg.select(*by, "n", "mae", F.sqrt("_mse").alias("rmse"),
                      r2_expr(F.col("_sse"), F.col("_sst")).alias("r2"))


def r2_gap(metrics: DataFrame, train: str = "train", test: str = "test") -> DataFrame:
    """EV3: ``model, r2_train, r2_test, r2_gap`` (train minus test)."""
    piv = metrics.groupBy("model").pivot("split", [train, test]).agg(F.first("r2"))
    return piv.select("model", F.col(train).alias("r2_train"), F.col(test).alias("r2_test"),
                      (F.col(train) - F.col(test)).alias("r2_gap"))


def best_model(metrics: DataFrame, metric: str = "r2", order_col: str = "order") -> DataFrame:
    """TK5 + EV6: best model (max r2 with missing = 0; min otherwise with missing = +inf).

    Ties go to the first registered model (``order_col``).  Adds the verdict:
    ``achieved`` (r2 >= 0.9) and ``distance_pct`` = (0.9 - r2) * 100.
    An empty metric table gives an empty result.
    """
    if metric == "r2":
        score = F.coalesce(F.col(metric), F.lit(0.0))
        ranked = metrics.orderBy(score.desc(), F.col(order_col).asc())
    else:
        score = F.coalesce(F.col(metric), F.lit(float("inf")))
        ranked = metrics.orderBy(score.asc(), F.col(order_col).asc())
    top = ranked.limit(1)
    r2 = F.coalesce(F.col("r2"), F.lit(0.0))
    return top.select("model", F.col(metric).alias(f"best_{metric}"),
                      (r2 >= F.lit(R2_TARGET)).alias("achieved"),
                      F.when(r2 < R2_TARGET, (F.lit(R2_TARGET) - r2) * 100).otherwise(F.lit(0.0))
                      .alias("distance_pct"))


def error_table(pred: DataFrame, label: str = "y", prediction: str = "p",
                keep: Sequence[str] = ()) -> DataFrame:
    """EV5 / SC13: ``Actual, Predicted, Error, AbsError, PercentError``."""
    return pred.select(*keep,
                       F.col(label).cast("double").alias("actual"),
                       F.col(prediction).cast("double").alias("predicted"),
                       S.error(label, prediction).alias("error"),
                       S.abs_error(label, prediction).alias("abs_error"),
                       S.percent_error(label, prediction).alias("percent_error"))


def blend(pred_a: Column, pred_b: Column, weight: float = BLEND_WEIGHT) -> Column:
    """MD4: ``w * a + (1 - w) * b``."""
    return F.lit(weight) * pred_a + F.lit(1.0 - weight) * pred_b


def keep_blend_if_better(metrics: DataFrame, base: str, blended: str, split: str = "test") -> DataFrame:
    """MD4: adds ``chosen``: of ``base`` and ``blended`` the blend only if its R² on ``split`` is higher, else the base model."""
    on = metrics.where((F.col("split") == split) & F.col("model").isin(base, blended))
    one = on.agg(*[F.max(F.when(F.col("model") == m, F.col("r2"))).alias(f"_{i}") for i, m in enumerate((base, blended))])
    better = F.coalesce(F.col("_1") > F.col("_0"), F.lit(False))
    return (metrics.crossJoin(F.broadcast(one))   # one row
            .withColumn("chosen", F.when(F.col("model") == base, ~better).when(F.col("model") == blended, better).otherwise(F.lit(True)))
            .drop("_0", "_1"))


def blended_importances(a: Sequence[float], b: Sequence[float], weight: float = BLEND_WEIGHT) -> list[float]:
    """MD4: ``w * a + (1 - w) * b`` of two models' importances over the same features."""
    return [weight * x + (1.0 - weight) * y for x, y in zip(a, b, strict=True)]


def importance_table(spark, names: Sequence[str], values: Sequence[float],
                     std: Sequence[float] | None = None) -> DataFrame:
    """IMP1: ``feature, importance, std`` sorted descending (name breaks ties)."""
    rows = [(n, float(v), None if std is None else float(std[i]))
            for i, (n, v) in enumerate(zip(names, values))]
    df = spark.createDataFrame(rows, "feature string, importance double, std double")
    return df.orderBy(F.col("importance").desc(), F.col("feature").asc())


def permutation_partners(df: DataFrame, cols: Sequence[str], key: Sequence[str], salt: int,
                         buckets: int) -> DataFrame:
    """EV4 building block: a seeded, distributed permutation of whole rows.

    Rows are hashed into ``buckets``; inside a bucket, the i-th row by one
    hash order is paired with the i-th row by another hash order and gets its
    values as ``_p_{col}``.  A bijection per bucket, so each column's
    multiset is unchanged.  The number of buckets grows with the data
    (``bucket_count``) and buckets are spread by a hash of the unique key, so
    no window ever holds a hot group.
    """
    from pyspark.sql import Window

    from .encode import stable_hash

    b = F.pmod(stable_hash(key, 7919 + salt), F.lit(buckets))
    base = df.withColumn("_pb", b)
    w_a = Window.partitionBy("_pb").orderBy(stable_hash(key, 104729 + salt), *key)
    w_b = Window.partitionBy("_pb").orderBy(stable_hash(key, 1299709 + salt), *key)
    rows = base.withColumn("_pi", F.row_number().over(w_a))
    vals = base.select("_pb", F.row_number().over(w_b).alias("_pi"),
                       *[F.col(c).alias(f"_p_{c}") for c in cols])
    return rows.join(vals, ["_pb", "_pi"], "inner").drop("_pb", "_pi")


def permutation_importance(model, data: DataFrame, names: Sequence[str], key: Sequence[str], repeats: int = PERM_REPEATS,
                           buckets: int | None = None) -> DataFrame:
    """EV4: ``feature, importance, std``: the mean and deviation of the R² lost when a feature's values are permuted.

    ``data`` has ``features``, ``label`` and the ``key`` of a row.  Each repeat
    is one permutation of the rows; a row then yields a copy for each feature
    that the model uses, with the partner's value in it, and all copies are
    scored in one job.  A tree model without a split on a feature gives the
    same predictions whatever its values: such features lose exactly nothing
    and yield no copies.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array

    names = list(names)
    used = sorted(set(model.featureImportances.indices.tolist())) if hasattr(model, "featureImportances") else list(range(len(names)))
    spark = data.sparkSession
    flat = data.select(*key, "label", vector_to_array("features").alias("x"))
    if buckets is None:
        buckets = bucket_count(flat.count(), parallelism=spark.sparkContext.defaultParallelism)
    copies = None
    for rep in range(repeats):
        one = permutation_partners(flat, ["x"], key, salt=rep, buckets=buckets).withColumn("repeat", F.lit(rep))
        copies = one if copies is None else copies.unionByName(one)
    which = F.array(*[F.lit(i) for i in used]).cast("array<int>")
    # the row's copies hold their own vector and one number of the partner's
    wide = copies.select("repeat", "label", "x", "_p_x", F.explode(which).alias("i")).select(
        "repeat", "label", "x", "i", F.get("_p_x", F.col("i")).alias("v"))
    vectors = wide.select("repeat", "label", "i", array_to_vector(
        F.transform("x", lambda old, j: F.when(j == F.col("i"), F.col("v")).otherwise(old))).alias("features"))
    scored = model.transform(vectors).select("i", "repeat", F.col("label").alias("y"), F.col("prediction").alias("p"))
    base = regression_metrics(model.transform(data).select(
        F.lit("base").alias("model"), F.col("label").alias("y"), F.col("prediction").alias("p")), by=("model",)).first()
    lost = regression_metrics(scored, by=("i", "repeat")).select("i", (F.lit(base["r2"] if base else None) - F.col("r2")).alias("_d"))
    per = lost.groupBy("i").agg(F.avg("_d").alias("importance"), F.stddev_pop("_d").alias("std"))
    every = spark.createDataFrame(list(enumerate(names)), "i int, feature string")
    return every.join(F.broadcast(per), "i", "left").select(   # one row for each feature
        "feature", F.coalesce("importance", F.lit(0.0)).alias("importance"), F.coalesce("std", F.lit(0.0)).alias("std")
    ).orderBy(F.col("importance").desc(), F.col("feature"))


def permuted_variants(partnered: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One copy of each row per column, with only that column taken from the partner."""
    variants = [F.struct(F.lit(c).alias("feature"),
                         *[(F.col(f"_p_{x}") if x == c else F.col(x)).alias(x) for x in cols])
                for c in cols]
    return partnered.select(*keep, F.explode(F.array(*variants)).alias("_v")).select(*keep, "_v.*")


def bucket_count(n_rows: int, rows_per_bucket: int = PERM_BUCKET_ROWS, parallelism: int = 1) -> int:
    """Buckets of at most ``rows_per_bucket`` rows, and as many as tasks can run at once."""
    return max(1, parallelism, -(-n_rows // rows_per_bucket))
