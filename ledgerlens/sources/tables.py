"""Parquet table sources and the role binding of the test tables.

``facts`` binds the TPC-H-like tables to the roles of the reference's source
table (one row per issued fine): year/month from the order date, four
categoricals, two counts and a money target.  See README for the mapping.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookup import join_small
from ..roles import Roles
from ..session import dealt, write_stage

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

FACT_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
# roles of the bound fact table (see README for the mapping)
FACT_ROLES = Roles(key=FACT_KEY)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def facts(spark: SparkSession, sf_dir: str, materialize: bool = False,
          columns: tuple[str, ...] = ()) -> DataFrame:
    """lineitem x orders x customer x nation x part with role-named columns.

    Join order keeps the two big shuffles on lineitem's own keys
    (orderkey, partkey); nation is a fixed-size dimension joined to customer
    behind a counted broadcast.  ``materialize=True`` writes the joined rows
    once as a parquet table in the checkpoint folder for callers that make
    several passes, so the join is not recomputed per pass and each pass
    reads only the columns it needs; ``columns`` (besides the key) says which.
    They are dealt to all cores (``session.dealt``), so that the passes are, too.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")

    cust_nation = join_small(customer, nation, "c_nationkey", "inner")
    order_dim = orders.join(
        cust_nation.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "inner"
    ).withColumnRenamed("o_orderkey", "l_orderkey")
    joined = li.join(order_dim, "l_orderkey", "inner").join(part, "l_partkey", "inner")
    out = joined.select(
        *FACT_KEY,
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.month("o_orderdate").cast("bigint").alias("month"),
        F.col("p_type").alias("sector"),
        F.col("n_name").alias("municipality"),
        F.col("o_orderstatus").alias("status"),
        F.col("p_brand").alias("legal_basis"),
        F.col("l_quantity").cast("double").alias("fines"),
        F.col("l_linenumber").cast("bigint").alias("taxpayers"),
        F.col("l_extendedprice").cast("double").alias("amount"),
    )
    if columns:
        out = out.select(*FACT_KEY, *columns)
    return write_stage(dealt(out, FACT_KEY, li.count()), "facts") if materialize else out


# SQL text of the same binding, used by the DuckDB oracle strings.
FACTS_SQL = """
facts AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber,
         CAST(year(o.o_orderdate) AS BIGINT) AS year,
         CAST(month(o.o_orderdate) AS BIGINT) AS month,
         p.p_type AS sector, n.n_name AS municipality, o.o_orderstatus AS status,
         p.p_brand AS legal_basis,
         CAST(l.l_quantity AS DOUBLE) AS fines,
         CAST(l.l_linenumber AS BIGINT) AS taxpayers,
         CAST(l.l_extendedprice AS DOUBLE) AS amount
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""
