"""Bounded samples of documents, labelled or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


#: Bytes of a text in an unlabelled sample at most; longer texts aren't sampled.
SAMPLE_BYTES = 1 << 17


def plain_sample(docs: DataFrame, rows: int, id_col: str = "doc_id", text_col: str = "text", keep: Column | None = None) -> DataFrame:
    """(h, text) of up to ``rows`` documents, by the order of a hash of id and text; rows equal in both count once.

    ``keep``: a condition on ``text``.  Of every so many hashes one is looked at,
    so that few reach the shuffle; the bound on rows and bytes holds whatever
    repeats.  The hashes are broadcast: ``rows`` of 8 bytes.
    """
    own = docs.select(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("h"), F.col(text_col).cast("string").alias("text"))
    own = own.where(F.octet_length("text") <= SAMPLE_BYTES)
    if keep is not None:
        own = own.where(keep)
    share = max(1, docs.count() // (16 * max(1, rows)))
    picked = own.select("h").where(F.pmod("h", F.lit(share)) == 0).distinct().orderBy("h").limit(rows)
    return own.join(F.broadcast(picked), "h").groupBy("h").agg(F.min("text").alias("text"))


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, left_out: int, rows_per_class: int,
           id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """Up to ``rows_per_class`` labelled documents of each class, and the number of labelled ids of each class.

    Only ids whose fold is not ``left_out`` count, here as in the numbers.  Ids
    are taken by the order of a hash of the id.  Null ids and null labels are
    left out, an id with several labels has the largest, a document that
    occurs in several rows is taken once.  The sampled ids are broadcast: at
    most 2 x ``rows_per_class`` of them.
    """
    rows = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
            .where("id is not null and y in (0, 1)").where(fold("id", parts) != left_out)
            .groupBy("id").agg(F.max("y").alias("y")))
    sizes = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    picked = None
    for y in sorted(sizes):
        some = rows.where(F.col("y") == y).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(rows_per_class)
        picked = some if picked is None else picked.unionByName(some)
    if picked is None:
        picked = rows.limit(0)
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    joined = own.join(F.broadcast(picked), "id")
    one = joined.groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    return one.select("id", "y", F.col("t.text").alias("text")), sizes
