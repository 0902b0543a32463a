"""Query op2_warc: pages written to WARC archives, read back and assembled."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import warc
from .scratch import Scratch


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page's capture."""
    scratch = Scratch(spark, "warc")
    path = scratch.path("archive")
    warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path, scratch)
    nested = warc.captures(scratch.write(warc.records(spark, path, payload=False), "records"))
    field = lambda name: F.regexp_extract("metadata.fields", f"(?m)^{name}: (-?[0-9]+)\r?$", 1)
    number = lambda c: F.when(c != "", c.cast("long"))
    return nested.select(
        number(field("page-id")).alias("page_id"),
        F.coalesce("response.payload_bytes", number(field("payload-bytes"))).alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        F.col("response.refers_to_page").cast("long").alias("refers_to"))


ORACLE = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
    SELECT page_id, strlen(payload) AS payload_bytes,
        array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + CAST((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS BIGINT), 1)), '') AS payload_digest
    FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""
