"""WARC archives: writing page captures, reading them back, assembling transactions.

A capture is three records: a response (or a revisit, when an equal payload is
already archived), the request and a metadata record, both concurrent to the
first by its record id.  Archives are written by Spark's own text writer: a
record ends with two line breaks (CR LF), which is the writer's line
separator, and files are whole-file gzip.  Reading streams each file once,
takes records by their Content-Length and checks every payload digest;
``captures`` then joins the three kinds of record through their concurrent-to
identifiers and gives one nested row per capture.

Edge cases.  A null payload is an empty one; a null url leaves out
WARC-Target-URI.  Of rows with equal payloads (of at least ``least_bytes``
bytes) those with the smallest page_id are responses and the others revisit
it, nulls last; rows that repeat that page_id are responses as well, and
payloads under null ids only are all responses.  Every row has a capture of
its own, repeated or not.  Line breaks in urls are percent-encoded.  Of
several requests or metadata records concurrent to one response the one with
the smallest record id counts; a capture without them has nulls there.  Only
the named columns are read; an empty table gives no captures.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .scratch import Scratch
from .ship import map_arrow

#: Records of a file: a third as many captures.
FILE_RECORDS = 1500
CRLF = "\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(text: Column) -> Column:
    """Bare upper-case base-32 SHA-1 of a string's UTF-8 bytes (five hex digits are four characters)."""
    h = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in cuts)), F.lit(">"))


def _record(kind: str, record_id: Column, block: Column, *fields: tuple[str, Column]) -> Column:
    """Header and block of a record, without the two line breaks at its end; fields that are null are left out."""
    named = [("WARC-Type", F.lit(kind)), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit("2024-01-01T00:00:00Z")), *fields,
             ("Content-Length", F.octet_length(block).cast("string"))]
    lines = [F.lit("WARC/1.1")] + [F.concat(F.lit(f"{k}: "), v) for k, v in named]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block)


def write(pages: DataFrame, path: str, scratch: Scratch, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", least_bytes: int = 0) -> None:
    """Write the pages' captures as WARC files (gzip) below ``path``."""
    p = pages.select(F.col(id_col).cast("string").alias("page"), F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    p = p.withColumn("digest", sha1_base32(F.col("payload"))).withColumn("size", F.octet_length("payload"))
    firsts = (p.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("digest", "first"))
    # written first, so that Spark knows its size: a small one is broadcast, a large one joined by shuffle
    p = p.join(scratch.write(firsts, "firsts"), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    key = _uuid(F.lit("capture"), F.col("page"), F.col("digest"), F.monotonically_increasing_id().cast("string"))
    p = p.select("*", key.alias("key"), again.alias("again"), F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("uri"))
    p = p.withColumn("uri", F.regexp_replace("uri", "^ +| +$", ""))
    key, uri, size = F.col("key"), ("WARC-Target-URI", F.when(F.col("uri") != "", F.col("uri"))), F.col("size").cast("string")
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(CRLF * 2))
    kind = ("Content-Type", F.lit("application/http; msgtype=response"))
    response = _record("response", key, F.concat(http, F.col("payload")), uri, kind, digest)
    revisit = _record("revisit", key, http, uri, kind, digest, ("WARC-Profile", F.lit(REVISIT)),
                      ("WARC-Refers-To-Page", F.col("first").cast("string")))
    request = _record("request", _uuid(F.lit("request"), key),
                      F.concat(F.lit("GET "), F.coalesce(F.regexp_extract("uri", "^[^:/?#]+://[^/?#]*([^#]*)", 1), F.lit("")), F.lit(" HTTP/1.1\r\nHost: "),
                               F.coalesce(F.regexp_extract("uri", "^[^:/?#]+://([^/?#]*)", 1), F.lit("")), F.lit(CRLF * 2)),
                      uri, ("Content-Type", F.lit("application/http; msgtype=request")), ("WARC-Concurrent-To", key))
    metadata = _record("metadata", _uuid(F.lit("metadata"), key),
                       F.concat_ws("", F.concat(F.lit("page-id: "), F.col("page"), F.lit(CRLF)), F.concat(F.lit("payload-bytes: "), size, F.lit(CRLF))),
                       uri, ("Content-Type", F.lit("application/warc-fields")), ("WARC-Concurrent-To", key))
    records = p.select(F.explode(F.array(request, F.when(F.col("again"), revisit).otherwise(response), metadata)).alias("value"))
    (records.write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)
     .option("zlib.compress.level", "BEST_SPEED").text(path))


def parse(stream: io.BufferedIOBase):
    """(named fields in lower case, block) of each record of a WARC file."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')} is cut off")
        yield fields, block


def records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``; the payload of responses only if asked for."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (
        "type", "record_id", "concurrent_to", "target_uri", "date", "payload_digest", "refers_to_page", "fields")]
        + [T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                with gzip.open(io.BytesIO(content.as_buffer())) as stream:
                    for f, block in parse(stream):
                        rows.append(_row(f, block, payload))
                        if len(rows) == 500 or payload and len(block) > 1 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=out)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=out)

    out = pa.schema([(f.name, pa.int64() if f.name == "payload_bytes" else pa.binary() if f.name == "payload" else pa.string()) for f in schema])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return map_arrow(files, run, schema)


def _row(f: dict, block: bytes, payload: bool) -> dict:
    kind = f["warc-type"]
    body = block[block.index(b"\r\n\r\n") + 4:] if kind == "response" else None
    digest = f.get("warc-payload-digest")
    if body is not None and digest and digest != "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode():
        raise ValueError(f"record {f['warc-record-id']}: payload and digest differ")
    return {"type": kind, "record_id": f["warc-record-id"], "concurrent_to": f.get("warc-concurrent-to"),
            "target_uri": f.get("warc-target-uri"), "date": f.get("warc-date"), "payload_digest": digest and digest[5:],
            "refers_to_page": f.get("warc-refers-to-page"), "fields": block.decode() if kind in ("metadata", "request") else None,
            "payload_bytes": None if body is None else len(body), "payload": body if payload else None}


def captures(found: DataFrame) -> DataFrame:
    """One nested row per capture: response (or revisit), request and metadata, joined by concurrent-to."""
    main = found.where(F.col("type").isin("response", "revisit")).select(
        "record_id", F.struct("type", "target_uri", "date", "payload_digest", "refers_to_page", "payload_bytes", "payload").alias("response"))

    def beside(kind: str) -> DataFrame:
        return (found.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
                .groupBy(F.col("concurrent_to").alias("record_id")).agg(F.min(F.struct(F.col("record_id").alias("own_id"), "target_uri", "fields")).alias(kind)))

    return main.join(beside("request"), "record_id", "left").join(beside("metadata"), "record_id", "left")
