"""Delimited-file sources and sinks (IO1-IO4) and cleaning (PR7-PR9, ST1).

The reference converts spreadsheets one by one in a loop and appends to a
growing frame; here a file list becomes one union plan that Spark reads in
parallel.  Spreadsheet decoding itself is not rebuilt (see README).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             header: bool = True, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """IO1: header CSV scan.  Pass a schema in production; without one the
    types are inferred (an extra pass, for discovery only)."""
    reader = spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path if isinstance(path, str) else list(path))


def write_csv(df: DataFrame, path: str, quote_all: bool = False, mode: str = "overwrite") -> str:
    """IO2 / IO4: header CSV sink (no index column); ``quote_all`` quotes every field."""
    (df.write.mode(mode).option("header", True).option("quoteAll", quote_all)
       .option("encoding", "UTF-8").csv(path))
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def expand_inputs(spark: SparkSession, inputs: str | Sequence[str]) -> list[str]:
    """IO3: expand the wildcards of every input on the file system it names.

    Each input must match a file: one that matches nothing is an error, also
    among others that do.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out: list[str] = []
    for item in [inputs] if isinstance(inputs, str) else list(inputs):
        path = jvm.org.apache.hadoop.fs.Path(item)
        hits = path.getFileSystem(conf).globStatus(path)
        if not hits:
            raise FileNotFoundError(f"no input files match {item!r}")
        out += sorted(h.getPath().toString() for h in hits)
    if not out:
        raise FileNotFoundError("no inputs")
    return out


def placeholder_headers(df: DataFrame, prefix: str = "Unnamed") -> DataFrame:
    """PR9: headers that are empty or start with ``Unnamed`` become unique ``_c{i}``."""
    names = []
    for i, c in enumerate(df.columns):
        names.append(f"_c{i}" if (not c.strip() or c.startswith(prefix)) else c)
    return df.toDF(*names)


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    """PR7: drop rows where every value is null."""
    return df.na.drop("all")


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """PR8: drop columns with no non-null value (one aggregate of counts)."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    keep = [c for c in df.columns if counts[c] > 0]
    return df.select(*keep)


def drop_empty(df: DataFrame) -> DataFrame:
    """PR7 + PR8 in the reference's order (rows first, then columns)."""
    return drop_all_null_columns(drop_all_null_rows(df))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """ST1: bag union by column name; absent columns become null; duplicates kept."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def headers_of(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """The first line of every file, and the files that have it, from one job over all files."""
    lines = spark.read.text(list(paths)).where(F.col("_metadata.file_block_start") == 0)
    first = lines.select(F.col("_metadata.file_path").alias("path"), F.struct(F.monotonically_increasing_id().alias("at"), "value").alias("line"))
    rows = first.groupBy("path").agg(F.min("line")["value"].alias("header")).collect()  # a row for each file
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: r.path):
        out.setdefault(r.header, []).append(r.path)
    return out


def ingest(spark: SparkSession, inputs: str | Sequence[str], schema=None, sep: str = ",",
           source_col: str | None = "source_file") -> DataFrame:
    """IO3: expand, read every file, clean each (PR7, PR9, PR8) and union (ST1).

    One job finds all headers; files of one header are one scan, so that the
    plan grows with the number of headers, not of files.  A column that is empty
    in a file is null in that file's rows of the union anyway; which columns
    are empty in all files (PR8) comes from one aggregate.  ``source_col``
    takes the file from the scan's metadata.  Empty files add no rows.
    """
    frames = []
    for paths in headers_of(spark, expand_inputs(spark, inputs)).values():
        df = read_csv(spark, paths, schema=schema, sep=sep)
        names = placeholder_headers(df).columns
        rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)],
                         *([F.col("_metadata.file_path").alias(source_col)] if source_col else []))
        frames.append(rows.na.drop("all", subset=names))
    every = union_by_name(frames)
    names = [c for c in every.columns if c != source_col]
    counts = every.agg(*[F.count(F.col(f"`{c}`")) for c in names]).first()
    full = [c for c, n in zip(names, counts) if n]
    return every.select(*[F.col(f"`{c}`") for c in full], *([source_col] if source_col else []))
