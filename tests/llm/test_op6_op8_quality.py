"""Text statistics, rule ensemble and isolation forest against plain versions; held-out accuracy; edge cases."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st_
from pyspark.sql import functions as F

from ledgerlens.llm import quality, quality_rules as qr, statistics as st
from ledgerlens.llm.op6_quality import op6_quality
from ledgerlens.llm.op8_quality_rules import op8_quality_rules

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=300, deadline=None)
@given(st_.lists(st_.text(alphabet="ab \n\t\r#|é\x0b", max_size=40), max_size=5))
def test_counts(texts):
    c = st.counts(pa.array(texts, pa.string()))
    assert [tuple(int(c[k][i]) for k in qr.COUNTS) for i in range(len(texts))] == [plain_counts(t) for t in texts]


def test_rules_query(spark):
    got = {r.doc_id: r for r in op8_quality_rules(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == len(docs)
    kept = {0: [], 1: []}
    for d in docs:
        r, want = got[d.doc_id], plain_counts(d.text)
        assert tuple(r[k] for k in qr.COUNTS) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
        if d.doc_id in labels and not r.base_failed:
            kept[labels[d.doc_id]].append(r.kept)
    assert np.mean(kept[1]) > 0.97 and np.mean(kept[0]) < 0.6


def test_forest_paths_equal_a_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    forest = qr.grow(x, np.random.default_rng(2), trees=20, sample=64)
    odd = np.vstack([x[:30], [[9, 9, 9, 9]]])
    want = []
    for row in odd:
        total = 0
        for node in forest["roots"]:
            while forest["feature"][node] >= 0:
                node = forest["left" if row[forest["feature"][node]] <= forest["split"][node] else "right"][node]
            total += forest["length"][node]
        want.append(2 ** -(total / 20 / qr.usual(64)))
    got = qr.anomaly(forest, odd)
    assert np.allclose(got, want) and got.argmax() == 30


def test_tree_rules_are_the_paths_of_a_printed_tree():
    text = """DecisionTreeClassificationModel: depth=2
  If (feature 3 <= 0.5)
   If (feature 1 <= 2.0)
    Predict: 1.0
   Else (feature 1 > 2.0)
    Predict: 0.0
  Else (feature 3 > 0.5)
   If (feature 3 <= 0.9)
    Predict: 0.0
   Else (feature 3 > 0.9)
    Predict: 1.0
"""
    assert quality.tree_rules(text) == {
        ((3, True, 0.5),), ((1, True, 2.0), (3, True, 0.5)), ((1, False, 2.0), (3, True, 0.5)),
        ((3, False, 0.5),), ((3, False, 0.5), (3, True, 0.9)), ((3, False, 0.9),)}


def test_compiled_score_equals_the_rules(spark):
    model = {"base": -0.5, "share": 0.5, "rules": [(((0, True, 1.0), (1, False, 2.0)), 1.5), (((1, True, 2.0),), -2.0)]}
    rows = [(0.5, 3.0), (0.5, 2.0), (1.5, 9.0), (1.0, 2.1)]
    got = [r[0] for r in spark.createDataFrame(rows, "s0 double, s1 double").select(quality.expression(model)).collect()]
    want = [1 / (1 + np.exp(0.5 - (1.5 if a <= 1 and b > 2 else 0) + (2 if b <= 2 else 0))) for a, b in rows]
    assert np.allclose(got, want)


def test_quality_held_out_accuracy(spark):
    got = op6_quality(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in got)
    out = [r.predicted == labels[r.doc_id] for r in got if r.held_out and r.doc_id in labels]
    assert np.mean(out) > 0.95


def test_edge_cases(spark):
    good = [(i, f"This is an ordinary line of text number {i}. " * (6 + i % 5)) for i in range(60)]
    bad = [(100 + i, "SHOUT!! | # " * (20 + i % 7)) for i in range(30)]
    extra = [(None, None), (500, ""), (501, "SHOUT!! | # " * 9000), (3, good[3][1]), (None, good[4][1])]
    df = spark.createDataFrame(good + bad + extra, "doc_id long, text string").selectExpr("doc_id", "text", "text as s0", "doc_id as k0")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (7, None), (998, 0)], "doc_id long, quality int")
    model = quality.fit(df, labels)
    got = [(r.doc_id, r.score) for r in quality.scored(df, model).collect()]
    assert len(got) == 95 and all(0 <= s <= 1 for _, s in got)
    assert all(s > 0.5 for d, s in got if d is not None and d < 60) and all(s < 0.5 for d, s in got if d is not None and 100 <= d < 130 or d == 501)
    assert quality.scored(df.limit(0), model).count() == 0
    assert {r.score for r in quality.scored(df, quality.fit(df, labels.limit(0))).collect()} == {0.0}
    assert {r.score for r in quality.scored(df, quality.fit(df, labels.where("quality = 1"))).collect()} == {1.0}
    rules = qr.judged(df, qr.fit(df, labels))
    assert rules.count() == 95
    assert rules.where(F.col("doc_id").isNull() | (F.col("doc_id") == 500)).where("base_failed and not kept and n_words = 0").count() == 2
    assert qr.judged(df, qr.fit(df, labels.limit(0))).where("kept = base_failed").count() == 0
    empty = df.limit(0)
    assert qr.judged(empty, qr.fit(empty, labels)).count() == 0


def test_forest_and_threshold_take_every_row(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, len(qr.NUMBERS)))
    rows = spark.createDataFrame([(i, i, *[0] * len(qr.COUNTS), False, *map(float, v)) for i, v in enumerate(x)],
                                 ", ".join(["doc_id long", "h long", *(f"{c} long" for c in qr.COUNTS), "base_failed boolean", *(f"{n} double" for n in qr.NUMBERS)]))
    labels = [(i, int(rng.random() < 0.7)) for i in range(650)] + [(3, 1), (None, 1), (7, None)]
    model = qr.fit_measured(rows.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int"))
    forest = model["forest"]
    assert forest["usual"][0] == qr.usual(700)
    for root in forest["roots"][:10]:  # a leaf's length counts all rows that end there
        at = qr.ends(forest, root, x)
        depth = {int(root): 0}
        for node in range(len(forest["feature"])):
            if node in depth and forest["feature"][node] >= 0:
                depth[int(forest["left"][node])] = depth[int(forest["right"][node])] = depth[node] + 1
        for node, n in zip(*np.unique(at, return_counts=True)):
            assert np.isclose(forest["length"][node], depth[node] + qr.usual(n))
    again = qr.fit_measured(rows.repartition(5), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert again["bound"] == model["bound"] and all((again["forest"][k] == v).all() for k, v in forest.items())
    assert all((qr.grow(x, np.random.default_rng(1))[k] == v).all() for k, v in forest.items())


def test_threshold_is_the_cheapest_score(spark):
    from ledgerlens.llm.scratch import Scratch
    rng = np.random.default_rng(6)
    for cost in (0.3, 1.0, 20.0):
        good, bad = rng.integers(0, 60, 400) / 100, rng.integers(30, 90, 150) / 100
        at = np.unique(np.concatenate([good, bad, [1.0]]))
        costs = [cost * np.mean(good > t) + np.mean(bad <= t) for t in at]
        marked = spark.createDataFrame([(float(v), 1) for v in good] + [(float(v), 0) for v in bad], "score double, y int")
        got = qr.threshold(marked.repartition(4), Scratch(spark, "test"), cost)
        assert np.isclose(costs[list(at).index(got)], min(costs))
    assert qr.threshold(marked.where("y = 1"), Scratch(spark, "test")) == 1.0
