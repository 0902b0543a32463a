"""Personal data: base patterns against plain regular expressions, message passing against enumeration, edge cases."""

import hashlib
import itertools
import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from ledgerlens.llm import pii
from ledgerlens.llm.op5_pii import op5_pii

SF = "/root/testdata/sf0.01"


def plain(text):
    """The contract's patterns as they are written."""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def digest(spans):
    return hashlib.sha256(",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a.@-_1 25(+)é0", max_size=40))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


def test_base_spans_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a.b@" * 80_000, "@" * 300_000, "+1(" + "(" * 300_000):
        pii.base_spans(text)


def test_query_base_counts_equal_plain_patterns(spark):
    got = {r.doc_id: r for r in op5_pii(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        want, g = plain(r.text or ""), got[r.doc_id]
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(sum(s[0] == k for s in want) for k in range(4))
        assert g.base_sha256 == digest(want)
        every = [x for x in g.spans.split(",") if x]
        assert {f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in want} <= set(every)


def test_messages_are_exact_on_trees():
    rng = np.random.default_rng(0)
    n = 5
    model = {"unary": rng.normal(size=(pii.FEATURES, pii.LABELS)), "chain": rng.normal(size=(pii.LABELS,) * 2),
             "skip": rng.normal(size=(pii.LABELS,) * 2)}
    x = rng.random((n, pii.FEATURES))
    y = np.array([0, 0, 2, 0, 0])
    chain, skip = np.array([[0, 1], [3, 4]]), np.array([[1, 2], [2, 3]])
    got = pii.marginals(model, x, y, chain, skip, rounds=60)
    want = np.zeros((n, pii.LABELS))
    unary = x @ model["unary"]
    for z in itertools.product(range(pii.LABELS), repeat=n):
        if z[2] == 2:
            s = sum(unary[i, z[i]] for i in range(n) if i != 2)
            s += sum(model["chain"][z[i], z[j]] for i, j in chain) + sum(model["skip"][z[i], z[j]] for i, j in skip)
            for i in range(n):
                want[i, z[i]] += np.exp(s)
    assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-6)


def learnt():
    rng = random.Random(4)
    graph = pii.Graph()
    for i in range(300):
        ip = ".".join(str(rng.randrange(256)) for _ in range(4))
        text = (f"w{i} mail ab.{rng.randrange(99)}@m{rng.randrange(9)}.org then +1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)} "
                f"of {ip} and 4111111111111111 or {rng.randrange(10**15, 10**16)} in {rng.randrange(3000)} v{rng.randrange(9)}.{rng.randrange(9)} end")
        graph.add(i, text, pii.base_spans(text))
    return pii.train(*graph.arrays())


def test_repeated_tokens_share_labels():
    model = learnt()
    texts = ["call +1 (269) 555-3296 now. Later: 555-3296 again", "only 555-3296 here", "+1 (826) 555-4081 190.137.223.204 du",
             "plain 2024 words v2.0 of 17"]
    got = [[(pii.KINDS[k], t[s:e]) for k, s, e in every] for t, (_, every) in zip(texts, pii.spans_of(texts, model))]
    assert ("phone", "+1 (269) 555-3296") in got[0] and ("phone", "555-3296") in got[0]
    assert ("phone", "+1 (826) 555-4081") in got[2] and ("ip", "190.137.223.204") in got[2]
    assert got[3] == []


def test_hot_token_is_linear():
    text = "x 555-3296 " * 20_000 + "+1 (269) 555-3296"
    graph = pii.Graph()
    graph.add(0, text, pii.base_spans(text))
    assert len(graph.skip) <= 20_001


def test_evidence_reaches_all_occurrences():
    model = learnt()
    eye = np.eye(pii.LABELS)
    model |= {"unary": np.zeros_like(model["unary"]), "chain": np.zeros((pii.LABELS, pii.LABELS)), "skip": 3 * eye}
    for n in (40, 2000):
        for text in ("x 555-3296 " * n + "+1 (269) 555-3296", "+1 (269) 555-3296" + " x 555-3296" * n):
            ((base, every),) = pii.spans_of([text], model)
            assert len(base) == 1 and sum(text[s:e] == "555-3296" and k == 3 for k, s, e in every) == n
    graph = pii.Graph()
    graph.add(0, text, pii.base_spans(text))
    assert len(graph.far) < 2 * n


def test_messages_converge_along_a_long_chain():
    n = 60
    model = {"unary": np.zeros((pii.FEATURES, pii.LABELS)), "chain": 6 * np.eye(pii.LABELS), "skip": np.zeros((pii.LABELS, pii.LABELS))}
    chain = np.stack([np.arange(n - 1), np.arange(1, n)], 1)
    got = pii.marginals(model, np.zeros((n, pii.FEATURES), np.float32), np.array([4] + [0] * (n - 1)), chain, np.zeros((0, 2), np.int64))
    step = np.exp(model["chain"]) / np.exp(model["chain"]).sum(1, keepdims=True)
    assert np.allclose(got[-1], np.linalg.matrix_power(step, n - 1)[4], atol=1e-4)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "é a@b.c"), (3, "a@b.c x@y.z"), (3, "a@b.c x@y.z"), (4, "word " * 50000 + "9.9.9.9"), (5, "no data")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "text as spans", "length(text) as n_chars")
    model = pii.fit(df)
    got = sorted(((r.doc_id, r.n_email, r.n_ip, r.spans) for r in pii.found(df, model).collect()), key=str)
    assert got == sorted([(1, 0, 0, ""), (2, 0, 0, ""), (None, 1, 0, "email:2:7"), (3, 2, 0, "email:0:5,email:6:11"),
                          (3, 2, 0, "email:0:5,email:6:11"), (4, 0, 1, "ip:250000:250007"), (5, 0, 0, "")], key=str)
    clean = pii.redacted(df, model)
    assert clean.columns == df.columns
    out = sorted(((r.doc_id, r.text, r.n_chars) for r in clean.where("doc_id is null or doc_id != 4").collect()), key=str)
    assert out == sorted([(1, None, None), (2, "", 0), (None, "é [EMAIL]", 9), (3, "[EMAIL] [EMAIL]", 15),
                          (3, "[EMAIL] [EMAIL]", 15), (5, "no data", 7)], key=str)
    assert clean.where("doc_id = 4").first().text.endswith("word [IP]")
    assert pii.found(df.limit(0), pii.fit(df.limit(0))).count() == 0
