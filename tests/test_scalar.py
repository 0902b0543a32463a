import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import scalar as S
from ledgerlens.operators.bins import histogram
from ledgerlens.operators.profile import numeric_profile, skewness_g1


def col(spark, values, expr, typ="int"):
    df = spark.createDataFrame([(v,) for v in values], f"m {typ}")
    return [r[0] for r in df.select(expr).collect()]


def test_season_quarter_summer_winter(spark):
    assert col(spark, [12, 1, 2, 3, 6, 9], S.season("m")) == [1, 1, 1, 2, 3, 4]
    assert col(spark, [1, 3, 4, 12], S.quarter_of_month("m")) == [1, 1, 2, 4]
    assert col(spark, [6, 8, 9], S.is_summer("m")) == [1, 1, 0]
    assert col(spark, [12, 2, 3], S.is_winter("m")) == [1, 1, 0]


def test_month_sin_cos(spark):
    got = col(spark, [3], S.month_sin("m"))[0]
    assert got == pytest.approx(1.0)
    assert col(spark, [6], S.month_cos("m"))[0] == pytest.approx(-1.0)


def test_guarded_ratio_null_not_error(spark):
    # FIXTURES SC2: a=1, b=-0.001 -> NULL via try_divide
    df = spark.createDataFrame([(1.0, -0.001)], "a double, b double")
    assert df.select(S.guarded_ratio("a", "b")).first()[0] is None


def test_qcut_bin_expression(spark):
    # FIXTURES SC12: 1,2,3,4 with q=2 -> edges 1,2.5,4 -> bins 0,0,1,1
    assert col(spark, [1.0, 2.0, 3.0, 4.0], S.qcut_bin("m", [1.0, 2.5, 4.0]), "double") == [0, 0, 1, 1]
    assert col(spark, [1.0, 1.0, 2.0], S.qcut_bin("m", [1.0, 2.0]), "double") == [0, 0, 0]


def test_width_bin_last_closed(spark):
    # FIXTURES AG14: 0..5 with 30 bins, value 5 -> bin 30
    assert col(spark, [0.0, 5.0], S.width_bin("m", 0.0, 5.0, 30), "double") == [1, 30]
    h = histogram(spark.createDataFrame([(float(i),) for i in range(6)], "x double"), "x")
    rows = h.orderBy("bin").collect()
    assert len(rows) == 30 and sum(r["n"] for r in rows) == 6 and rows[-1]["n"] == 1


def test_percent_error_eps(spark):
    # FIXTURES EV5: y=0, p=1 -> 1e12
    df = spark.createDataFrame([(0.0, 1.0)], "y double, p double")
    assert df.select(S.percent_error("y", "p")).first()[0] == pytest.approx(1e12)


def test_g1_skewness(spark):
    # FIXTURES AG9: 0,0,1 -> G1 1.7320508
    df = spark.createDataFrame([(0.0,), (0.0,), (1.0,)], "x double")
    assert skewness_g1(df, "x") == pytest.approx(math.sqrt(3))
    prof = numeric_profile(df, ["x"]).first()
    assert prof["skew"] == pytest.approx(math.sqrt(3))


def test_int_cube_no_overflow(spark):
    df = spark.createDataFrame([(2_000_000,)], "m int")
    assert df.select(S.power("m", 3)).first()[0] == pytest.approx(8e18)


def test_days_in_month(spark):
    df = spark.createDataFrame([(2024, 2)], "y int, m int")
    d = df.select(S.month_start("y", "m").alias("d"))
    assert d.select(S.days_in_month("d")).first()[0] == 29
    assert d.select(F.quarter("d")).first()[0] == 1
