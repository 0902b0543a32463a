"""URL verdicts against plain parsing, against the query's SQL, and edge cases."""

import re

import duckdb

from ledgerlens.llm import url_reputation as ur
from ledgerlens.llm.op4_url_reputation import ORACLE, op4_url_reputation

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert sorted(map(str, con.execute(ORACLE).fetchall())) == sorted(str(tuple(r)) for r in op4_url_reputation(spark, SF).collect())


URLS = [None, "", "no scheme", "http://", "http://A.Org", "http://a.org/", "HTTP://U@X.example.ORG:80/es/a?b#c", "http://example.org/en/12",
        "http://example.org/en/2", "http://notexample.org/es/", "x://com/fr/", "x://a.com/fr", "x://a.com/de/?q", "x://a.net/p#f?g", "x://a.net?://b",
        "http://ÄÉ.com/de/\nx", "y://" + "a." * 3000 + "com/fr/z"]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for h, p, v in ur.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_parsing_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in ur.judged(pages, labels).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict = plain(url)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict or "allow")


def test_reputation_blocks_bad_hosts_only(spark):
    rows, labels = [], []
    for i in range(400):
        host = ["good.a.net", "bad.b.net", "new.b.net", "mixed.c.net"][i % 4]
        rows.append((i, f"http://{host}/{i}"))
        if i % 4 != 2:
            bad = i % 4 == 1 or i % 4 == 3 and i % 8 == 3
            labels.append((i, 1 - bad, 0))
    rows += [(None, "http://bad.b.net/n"), (5, "http://bad.b.net/5")]
    labels += [(None, 0, 1), (1, None, None), (9999, 0, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("page_id", "url", "url as host", "page_id as n")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = ur.judged(pages, labels, rules=()).collect()
    assert len(got) == len(rows)
    verdicts = {r.host: r.verdict for r in got}
    assert (verdicts["bad.b.net"], verdicts["good.a.net"], verdicts["mixed.c.net"]) == ("block", "allow", "allow")
    assert ur.judged(pages.limit(0), labels).count() == 0


def test_suffixes_of_several_labels(spark):
    hosts = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("x.org.uk",), ("uk",), ("a.b.c.d",), ("",)], "host string")
    cut = lambda s: {r.host: (r.domain, r.suffix) for r in hosts.select("host", *(
        c.alias(n) for c, n in zip(ur.registered(hosts.host, s), ("domain", "suffix")))).collect()}
    assert cut(()) == {"a.b.co.uk": ("co.uk", "uk"), "co.uk": ("co.uk", "uk"), "x.org.uk": ("org.uk", "uk"), "uk": ("uk", "uk"),
                       "a.b.c.d": ("c.d", "d"), "": ("", "")}
    assert cut(("co.uk", "b.co.uk"))["a.b.co.uk"] == ("a.b.co.uk", "b.co.uk")
    assert cut(("co.uk",)) == cut(()) | {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk")}
