"""Cuts, outputs and restored texts against a plain version; the boundary set against sorted lists."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import fill_in_middle as fim
from ledgerlens.llm.op13_fill_in_middle import op13_fill_in_middle

SF = "/root/testdata/sf0.001"


def plain(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(x in text for x in fim.SENTINELS) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < spm else "psm"
    return doc_id, len(units), form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_edge_cases(spark):
    rng = random.Random(1)
    rows = [(1, None), (2, ""), (None, "a\nb"), (3, "no end"), (3, "no end"), (4, "\n"), (5, "\n" * 200000), (6, "é日\U0001f937\n" * 50000 + "x"),
            (7, "a <P> b\nc"), (8, "<S"), (9, "\r\n\r\n"), (10, "x" * 300000 + "\ny")]
    rows += [(i, "".join(rng.choice("ab<P>S\né\U0001f937") for _ in range(rng.randrange(60)))) for i in range(20, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "text as output", "doc_id as n", "doc_id as h1")
    for rate, spm in ((100, 50), (60, 0), (0, 100)):
        out = fim.transformed(df, rate=rate, spm=spm)
        assert rows_of(out) == sorted((plain(*r, rate=rate, spm=spm) for r in rows), key=str)
        back = out.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("t"))
        assert rows_of(back) == sorted(((d, t or "") for d, t in rows), key=str)
    assert fim.transformed(df.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 2**32 - 1), st.sampled_from([0.001, 0.05, 0.5, 0.97]), st.integers(1, 300000))
def test_boundary_set(seed, share, span):
    rng = np.random.default_rng(seed)
    values = np.flatnonzero(rng.random(span) < share)
    if len(values):
        k = rng.integers(0, len(values), 50)
        assert (fim.BoundarySet(values).select(k) == values[k]).all()


def test_each_container_is_used():
    kinds = [type(fim.container(np.flatnonzero(x))) for x in (np.arange(60000) < 50000, np.arange(65536) % 50 == 0, np.arange(65536) % 3 == 0)]
    assert kinds == [fim.Runs, fim.Sorted, fim.Bitmap]


def test_query_equals_the_plain_version(spark):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [plain(r.doc_id, r.text) + (r.text or "",) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(op13_fill_in_middle(spark, SF)) == sorted(((*w[:5], sha(w[5]), sha(w[6])) for w in want), key=str)
