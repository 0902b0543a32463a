"""Column profiling and data-quality checks (AG1, AG9, R1-R5, R21).

Each profile is one aggregate pass (plus one ranked pass where quartiles are
needed); the wide one-row result is turned into a long table with
``explode(array(struct...))`` so nothing is looped on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import g1_from_population
from .order_stats import column_quantiles

IQR_FENCE = 1.5  # R2: Tukey fences at 1.5 x IQR


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """PR1: columns whose type is numeric (booleans excluded)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def kind_of(dt: T.DataType) -> str:
    if isinstance(dt, T.NumericType):
        return "numeric"
    if isinstance(dt, T.StringType):
        return "string"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    return dt.simpleString()


def is_missing(df: DataFrame, col: str) -> Column:
    """Null, or NaN for floating columns (pandas ``isnull``)."""
    dt = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _long(wide: DataFrame, rows: list[Column]) -> DataFrame:
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def kind_is_float(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("double", "float")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None,
                 distinct: str = "exact") -> DataFrame:
    """AG1 + R3: ``column, kind, nulls, null_pct, n_distinct`` in one pass.

    Exact distinct counts unpivot the columns in the row and combine
    ``(column, value)`` before the shuffle, whatever the number of columns;
    ``distinct="approx"`` uses HyperLogLog.
    """
    cols = list(cols or df.columns)
    if distinct == "exact":
        # text of a value; adding zero gives both zeros of a float one text
        text = [(F.col(c) + F.lit(0.0) if kind_is_float(df, c) else F.col(c)).cast("string").alias(f"v{i}")
                for i, c in enumerate(cols)]
        missing = [F.when(is_missing(df, c), 1).otherwise(0) for c in cols]
        cells = F.array(*[F.struct(F.lit(i).alias("i"), t.alias("v"), m.alias("m")) for i, (t, m) in enumerate(zip(text, missing))])
        values = df.select(F.explode(cells).alias("_x")).groupBy("_x.i", "_x.v").agg(
            F.count(F.lit(1)).alias("_c"), F.sum("_x.m").alias("_m"))
        per = values.groupBy("i").agg(F.sum("_c").alias("_n"), F.sum("_m").cast("bigint").alias("nulls"),
                                      F.count("v").cast("bigint").alias("n_distinct"))
        names = df.sparkSession.createDataFrame(
            [(i, c, kind_of(df.schema[c].dataType)) for i, c in enumerate(cols)], "i int, column string, kind string")
        return names.join(F.broadcast(per), "i", "left").select(   # one row per column: a proven bound
            "column", "kind", F.coalesce("nulls", F.lit(0).cast("bigint")).alias("nulls"),
            (F.lit(100.0) * F.try_divide("nulls", "_n")).alias("null_pct"),
            F.coalesce("n_distinct", F.lit(0).cast("bigint")).alias("n_distinct"))
    dcount = F.approx_count_distinct
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs.append(F.count_if(is_missing(df, c)).alias(f"_null{i}"))
        aggs.append(dcount(F.col(c)).alias(f"_dist{i}"))
    wide = df.agg(*aggs)
    rows = [F.struct(
        F.lit(c).alias("column"),
        F.lit(kind_of(df.schema[c].dataType)).alias("kind"),
        F.col(f"_null{i}").cast("bigint").alias("nulls"),
        (F.lit(100.0) * F.try_divide(F.col(f"_null{i}"), F.col("_n"))).alias("null_pct"),
        F.col(f"_dist{i}").cast("bigint").alias("n_distinct"),
    ) for i, c in enumerate(cols)]
    return _long(wide, rows)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, int]:
    """AG1 as driver scalars (one row)."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def skewness_g1(df: DataFrame, col: str) -> float | None:
    """AG9: bias-corrected sample skewness (pandas ``Series.skew``)."""
    row = df.agg(F.skewness(F.col(col).cast("double")).alias("g"),
                 F.count(F.col(col)).alias("n")).first()
    if row["g"] is None or row["n"] < 3:
        return None
    n = row["n"]
    return float(row["g"]) * (n * (n - 1)) ** 0.5 / (n - 2)


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None,
                    method: str = "exact", fence: float = IQR_FENCE) -> DataFrame:
    """``column, n, min, max, mean, std, skew, q1, q3, outliers``.

    Moments in one aggregate, quartiles of all columns in one ranked pass,
    outlier counts in a third pass against the literal fences.
    """
    cols = list(cols or numeric_columns(df))
    quart = column_quantiles(df, cols, [0.25, 0.75], method=method)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"mn{i}"),
                 F.max(x).alias(f"mx{i}"), F.avg(x).alias(f"av{i}"),
                 F.stddev_samp(x).alias(f"sd{i}"), F.skewness(x).alias(f"sk{i}")]
        q1, q3 = quart[c]
        if q1 is None:
            aggs.append(F.lit(0).cast("bigint").alias(f"o{i}"))
        else:
            iqr = q3 - q1
            aggs.append(F.count_if((x < q1 - fence * iqr) | (x > q3 + fence * iqr))
                        .alias(f"o{i}"))
    wide = df.agg(*aggs)
    rows = [F.struct(
        F.lit(c).alias("column"),
        F.col(f"n{i}").cast("bigint").alias("n"),
        F.col(f"mn{i}").alias("min"), F.col(f"mx{i}").alias("max"),
        F.col(f"av{i}").alias("mean"), F.col(f"sd{i}").alias("std"),
        g1_from_population(F.col(f"sk{i}"), F.col(f"n{i}")).alias("skew"),
        F.lit(quart[c][0]).cast("double").alias("q1"),
        F.lit(quart[c][1]).cast("double").alias("q3"),
        F.col(f"o{i}").cast("bigint").alias("outliers"),
    ) for i, c in enumerate(cols)]
    return _long(wide, rows)


def iqr_fences(df: DataFrame, cols: Sequence[str], fence: float = IQR_FENCE,
               method: str = "exact") -> dict[str, tuple[float, float]]:
    """R2: Tukey fences per column from exact quartiles (one ranked pass)."""
    q = column_quantiles(df, cols, [0.25, 0.75], method=method)
    out = {}
    for c in cols:
        q1, q3 = q[c]
        if q1 is None:
            continue
        out[c] = (q1 - fence * (q3 - q1), q3 + fence * (q3 - q1))
    return out


def cap_outliers(df: DataFrame, fences: dict[str, tuple[float, float]],
                 suffix: str = "_capped") -> DataFrame:
    """R2: winsorise to the fences; adds ``{col}{suffix}`` and ``{col}_is_outlier``."""
    cols = []
    for c, (lo, hi) in fences.items():
        x = F.col(c).cast("double")
        cols.append(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)).alias(f"{c}{suffix}"))
        cols.append(((x < lo) | (x > hi)).cast("int").alias(f"{c}_is_outlier"))
    return df.select("*", *cols)


def quality_checks(df: DataFrame, zero_cols: Sequence[str]) -> DataFrame:
    """R5 + R1: one row ``n_rows, dup_rows, zero_rows, null_rows``.

    ``dup_rows`` counts rows that repeat an earlier identical row (a group by
    all columns; identical rows collapse map-side, so a hot duplicate is cheap).
    """
    any_null = None
    for c in df.columns:
        t = is_missing(df, c)
        any_null = t if any_null is None else any_null | t
    any_zero = None
    for c in zero_cols:
        t = F.col(c) == 0
        any_zero = t if any_zero is None else any_zero | t
    base = df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(any_zero).alias("zero_rows"),
                  F.count_if(any_null).alias("null_rows"))
    dup_rows = (df.groupBy(*df.columns).count()
                  .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("d"))
                  .first()["d"])
    return base.select(
        F.col("n_rows").cast("bigint"), F.lit(int(dup_rows)).cast("bigint").alias("dup_rows"),
        F.col("zero_rows").cast("bigint"), F.col("null_rows").cast("bigint"))


def drop_incomplete_rows(df: DataFrame) -> DataFrame:
    """Drop rows with any null."""
    return df.na.drop("any")


def assert_no_nulls(df: DataFrame) -> None:
    """Raise if any null remains."""
    bad = {c: n for c, n in null_counts(df).items() if n}
    if bad:
        raise AssertionError(f"null values remain: {bad}")


def reconcile(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Per dimension, the category counts must sum to the table total.

    One scan: dimensions are unpivoted in-row, then ``(dim, value)`` counts
    are combined map-side.  Output ``dim, n_categories, total, rows, matches``.
    """
    long = df.select(*[F.col(d).cast("string").alias(d) for d in dims]).unpivot(
        [], list(dims), "dim", "value")
    per_cat = long.groupBy("dim", "value").agg(F.count(F.lit(1)).alias("n"))
    per_dim = per_cat.groupBy("dim").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_categories"),
        F.sum("n").cast("bigint").alias("total"))
    # a row has one value (or null) in each dimension: the rows' number is any dimension's total
    rows = F.max("total").over(Window.partitionBy())
    return per_dim.select("dim", "n_categories", "total", rows.alias("rows")).withColumn(
        "matches", F.col("total") == F.col("rows"))
