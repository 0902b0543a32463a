"""Totals of grouped tables are one-row aggregates: no task gets all categories."""

from ledgerlens.operators.trends import coverage, risk_score


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_totals_take_no_window_over_all_groups(spark):
    df = spark.range(3000).selectExpr("cast(id % 1000 as string) as k", "cast(id as double) as y")
    risk = risk_score(df, "k", "y")
    assert "Window" not in plan(risk)
    assert {r.k: r.risk for r in risk.collect()} == {str(i): (i + 1000) / 1499.5 for i in range(1000)}
    cover = coverage(df.union(df.limit(0)), "k")
    assert plan(cover).count("Window [") == 1 and "Limit" in plan(cover).split("Window [")[1]
    assert [(r.n, r.pct) for r in cover.collect()] == [(3, 0.1)] * 10


def test_groups_without_values_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 2.0), ("a", 4.0), ("b", None)], "k string, y double")
    assert {r.k: r.risk for r in risk_score(df, "k", "y").collect()} == {None: 2 / 3, "a": 4 / 3, "b": None}
    assert risk_score(df.limit(0), "k", "y").count() == 0 and coverage(df.limit(0), "k").count() == 0
