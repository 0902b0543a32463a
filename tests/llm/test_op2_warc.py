"""WARC archives: round trips and edge cases; the query against its SQL in DuckDB."""

import base64
import hashlib
import io

import duckdb
import pytest

from ledgerlens.llm import warc
from ledgerlens.llm.op2_warc import ORACLE, op2_warc
from ledgerlens.llm.scratch import Scratch

SF = "/root/testdata/sf0.01"


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = con.execute(ORACLE).fetchall()
    got = op2_warc(spark, SF)
    assert got.columns == [c[0] for c in con.description]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_round_trip_and_edge_cases(spark):
    rows = [(5, "http://a.org/x?y#z", "same"), (3, "http://b.org", "same"), (3, "http://b.org", "same"), (9, None, "same"), (None, "http://n.org/", "same"),
            (1, "http://e.org/1", None), (2, "http://e.org/2", ""), (7, "bad\r\nurl: x", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\né"),
            (8, "http://long.org/", "ü" * 300_000), (None, "http://only.org", "null id")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("page_id", "url", "html", "url as payload", "page_id as id")
    scratch = Scratch(spark, "t")
    path = scratch.path("w")
    warc.write(pages, path, scratch)
    got = warc.captures(warc.records(spark, path)).collect()
    assert len(got) == len(rows)
    seen = []
    for r in got:
        fields = dict(x.split(": ") for x in r.metadata.fields.split("\r\n") if x)
        page = int(fields["page-id"]) if "page-id" in fields else None
        seen.append((page, r.response.type, r.response.payload_digest, int(fields["payload-bytes"]), r.response.refers_to_page,
                     bytes(r.response.payload).decode() if r.response.payload is not None else None))
        assert r.request.fields.startswith("GET ")
    want = []
    for page, _, html in rows:
        text = html or ""
        first = {"same": 3, "": 1}.get(text, page)
        revisit = first is not None and page != first
        want.append((page, "revisit" if revisit else "response", digest(text), len(text.encode()), str(first) if revisit else None, None if revisit else text))
    assert sorted(map(str, seen)) == sorted(map(str, want))
    assert {r.response.target_uri for r in got} >= {"bad%0D%0Aurl: x", None}
    path = scratch.path("empty")
    warc.write(pages.limit(0), path, scratch)
    assert warc.captures(warc.records(spark, path)).count() == 0


def test_least_bytes_and_missing_records(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    scratch = Scratch(spark, "t")
    path = scratch.path("w")
    warc.write(pages, path, scratch, least_bytes=3)
    found = warc.records(spark, path)
    assert sorted(r.response.type for r in warc.captures(found).collect()) == ["response"] * 3 + ["revisit"]
    bare = warc.captures(found.where("type in ('response', 'revisit')")).collect()
    assert len(bare) == 4 and all(r.request is None and r.metadata is None for r in bare)


def test_damaged_records_are_refused():
    good = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <x>\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [b for _, b in warc.parse(io.BytesIO(good * 2))] == [b"ab"] * 2
    for bad in (good[:-6], good.replace(b": 2", b": 9"), b"junk\r\n" + good):
        with pytest.raises(ValueError):
            list(warc.parse(io.BytesIO(bad)))
