"""Connected components of an edge table, by alternating large and small stars.

Every round is two aggregations and two joins on the edges; Spark may split a
hot node in each of them (minima combine before the shuffle, and AQE splits
the joins), and no node's neighbours are gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v) links -> (node, comp): comp is the smallest node linked to node, directly or not.

    Only nodes with a link to another node are returned; nulls, loops and
    repeated links change nothing.
    """
    now = scratch.write(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.write(
            small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "links")
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(now)
        now = after
        if seen == state:
            break
        state = seen
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        roots.select("node", F.col("node").alias("comp")))
