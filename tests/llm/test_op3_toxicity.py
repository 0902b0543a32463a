"""Toxicity: FTRL against a plain version, held-out accuracy, edge cases."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa

from ledgerlens.llm import toxicity as tox
from ledgerlens.llm.op3_toxicity import op3_toxicity

SF = "/root/testdata/sf0.1"


def plain_ftrl(rows, y, epochs):
    z, n = {}, {}

    def weight(i):
        bound = 0 if i == "base" else tox.L1
        zi = z.get(i, 0.0)
        if abs(zi) <= bound:
            return 0.0
        return -(zi - math.copysign(bound, zi)) / ((tox.BETA + math.sqrt(n.get(i, 0.0))) / tox.ALPHA + tox.L2)

    for _ in range(epochs):
        for at, label in zip(rows, y):
            w = {i: weight(i) for i in [*at.tolist(), "base"]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i, wi in w.items():
                s = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / tox.ALPHA
                z[i] = z.get(i, 0.0) + g - s * wi
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_ftrl_equals_plain_version():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "b", "c", "dd", "bad"]) for _ in range(rng.randint(1, 12))) for _ in range(120)]
    y = np.array([float("bad" in t.split()) for t in texts])
    row, coord, n = tox.features(pa.array(texts))
    rows = [coord[row == i] for i in range(n)]
    at, w, base = tox.ftrl(rows, y, 3)
    want = plain_ftrl(rows, y, 3)
    assert abs(base - want.pop("base")) < 1e-9
    assert dict(zip(at.tolist(), w)).keys() == want.keys()
    assert all(abs(want[i] - x) < 1e-9 for i, x in zip(at.tolist(), w))


def test_features_are_grams_and_skip_grams():
    count = lambda t: len(tox.features(pa.array([t]))[1])
    assert count("one two") == 3  # two words, one pair
    assert count("a b c d") == 4 + 3 + 2 + 1
    assert count("One, TWO one") == 2 + 2 + 1  # words, neighbours, over one word
    assert (tox.features(pa.array(["Ab cD"]))[1] == tox.features(pa.array(["aB  cd!"]))[1]).all()
    assert count("") == 0


def test_held_out_accuracy(spark):
    got = op3_toxicity(spark, SF).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.7) for r in got)
    out = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    hits = sum(p and y for p, y in out)
    assert hits / sum(p for p, _ in out) > 0.9 and hits / sum(y for _, y in out) > 0.75


def test_edge_cases(spark):
    docs = [(i, f"word{i % 7} fine text") for i in range(40)] + [(100 + i, f"nasty word{i % 7} text") for i in range(40)]
    labels = [(i, 0) for i in range(40)] + [(100 + i, 1) for i in range(40)] + [(None, 1), (7, None), (999, 1), (100, 0)]
    extra = [(None, "nasty nasty"), (500, None), (501, ""), (1, "word1 fine text"), (502, "nasty " * 50000)]
    df = spark.createDataFrame(docs + extra, "doc_id long, text string").selectExpr("doc_id", "text", "doc_id as score", "text as c0")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = tox.fit(df, lab)
    got = [(r.doc_id, r.score) for r in tox.scored(df, model).collect()]
    assert len(got) == 85
    assert all(s > 0.7 for d, s in got if d is None or d == 502 or 100 <= d < 140)
    assert all(s < 0.5 for d, s in got if d is not None and (d < 40 or d in (500, 501)))
    kept = tox.accepted(df, model)
    assert kept.columns == df.columns and kept.count() == 43
    assert tox.scored(df.limit(0), model).count() == 0
    for none in (lab.limit(0), lab.where("toxic = 0")):
        assert {r.score for r in tox.scored(df, tox.fit(df, none)).collect()} == {0.0}
    assert {r.score for r in tox.scored(df, tox.fit(df.limit(0), lab)).collect()} != set()
