"""Registry of named queries: Spark callable + optional DuckDB oracle SQL.

Output conventions shared by both sides of every pair: integers are BIGINT,
doubles are rounded (``rnd``) and normalised so -0.0 becomes 0.0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def query(name: str, sql: str | None = None, headline: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        if headline:
            HEADLINE.append(name)
        return fn
    return deco


def rnd(c: Column | str, digits: int = 6) -> Column:
    """Spark side of the shared rounding (and -0.0 -> 0.0)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), digits) + F.lit(0.0)


def srnd(expr: str, digits: int = 6) -> str:
    """SQL side of the shared rounding (and -0.0 -> 0.0)."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def sql_lit(x: float) -> str:
    """A double literal that round-trips exactly."""
    return f"CAST({float(x)!r} AS DOUBLE)"
