"""Query op13_fill_in_middle: cut, reordered and restored texts of all documents, as digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .fill_in_middle import restored, transformed


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 over all documents."""
    out = transformed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
with hashed as (
  select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
units as (
  select doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as u,
    ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
    ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
  from hashed),
cuts as (
  select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 then 'plain'
         when h4 % 100 < 50 then 'spm' else 'psm' end as form
  from units),
parts as (
  select *, coalesce(array_to_string(u[1:a], ''), '') as p, coalesce(array_to_string(u[a + 1:b], ''), '') as m,
    coalesce(array_to_string(u[b + 1:], ''), '') as s
  from cuts)
select doc_id, cast(n as bigint) as n, form,
  cast(case when form <> 'plain' then length(p) end as bigint) as prefix_chars,
  cast(case when form <> 'plain' then length(m) end as bigint) as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
         else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from parts
"""
