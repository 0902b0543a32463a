"""Query op11_vector_codes: product-quantised codes of all embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .scratch import Scratch
from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, books_digest, coded, fit, with_label_error


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 over all whole vectors."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    fitted = fit(vectors)
    if fitted is None:
        none = vectors.limit(0).select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none.withColumns({"label_error": F.col("error"), "codebooks_sha256": F.lit("")})
    blocks, books = fitted
    scratch = Scratch(spark, "vector-codes")
    rows = with_label_error(scratch.write(coded(blocks, books), "codes"), scratch)
    return rows.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """One assignment and one set of codebooks for each round, over (vector, part, position, value) rows."""
    assign = """
near{r} as materialized (
  select v, part, entry, dist from (
    select x.v, x.part, b.entry, sum((x.value - b.value) * (x.value - b.value)) as dist,
      row_number() over (partition by x.v, x.part order by sum((x.value - b.value) * (x.value - b.value)), b.entry) as place
    from x join book{r} b using (part, position) group by x.v, x.part, b.entry) where place = 1)"""
    move = """
book{n} as materialized (
  select part, entry, position, coalesce(m.value, b.value) as value
  from book{r} b left join (
    select part, entry, position, cast(floor(sum(x.value) / count(*)) as bigint) as value
    from x join near{r} using (v, part) group by part, entry, position) m using (part, entry, position))"""
    steps = [s for r in range(ROUNDS) for s in (assign.format(r=r), move.format(r=r, n=r + 1))] + [assign.format(r=ROUNDS)]
    return f"""
with kept as (
  select vec_id, label, embedding, row_number() over (order by vec_id nulls last, embedding) - 1 as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0),
x as materialized (
  select v, (i * {PARTS}) // len(embedding) as part, i % (len(embedding) // {PARTS}) as position,
    cast(floor({SCALE} * embedding[i + 1]::double) as bigint) as value
  from kept, lateral (select unnest(range(len(embedding))) as i)),
book0 as materialized (select part, v as entry, position, value from x where v < {ENTRIES}),{",".join(steps)},
digest as (select sha256(string_agg(cast(value as varchar), ',' order by part, entry, position)) as codebooks_sha256 from book{ROUNDS}),
codes as (
  select v, string_agg(lower(printf('%02x', cast(entry as integer))), '' order by part) as code, cast(sum(dist) as bigint) as error
  from near{ROUNDS} group by v)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from kept join codes using (v), digest
"""


ORACLE = _sql()
