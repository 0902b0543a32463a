"""Cross-entropy differences against plain dictionaries, and edge cases."""

import math
import random
import re
from collections import Counter

from ledgerlens.llm import language_model as lm
from ledgerlens.llm.op7_language_model import op7_language_model

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, target):
    single, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for d, t in rows:
        w = words(t)
        for k in (0, 1) if d in target else (0,):
            single[k].update(w)
            pairs[k].update(zip(w, w[1:]))
    kinds = sum(c >= 2 for c in single[0].values())
    out = []
    for d, t in rows:
        w, loss = words(t), [0.0, 0.0]
        for k in (0, 1):
            total = sum(single[k].values())
            for i, x in enumerate(w):
                p = (single[k][x] + 1) / (total + kinds + 1)
                if i and single[k][w[i - 1]]:
                    p = 0.5 * pairs[k][w[i - 1], x] / single[k][w[i - 1]] + 0.5 * p
                if single[0][x] < 2:
                    p = 1 / (kinds + 1)
                loss[k] -= math.log2(p)
        out.append((d, len(w), loss[1] / len(w), loss[0] / len(w)) if w else (d, 0, None, None))
    return out


def test_scores_equal_plain_models(spark):
    rng = random.Random(1)
    vocabulary = [f"W{i}" for i in range(60)]
    rows = [(i, ", ".join(rng.choices(vocabulary[i % 2 * 20:], k=rng.randint(1, 40)))) for i in range(80)]
    rows += [(1000, None), (1001, ""), (None, "W1 w2 unseen"), (3, "W1 w2"), (3, "W1 w2"), (1002, "w1 " * 40_000)]
    target = {i for i in range(0, 80, 2)} | {3}
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "text as score", "doc_id as slot").repartition(3)
    labels = spark.createDataFrame([(i,) for i in [*target, None, 3]], "doc_id long")
    got = sorted(((r.doc_id, r.n_words, r.target_loss, r.background_loss, r.score) for r in lm.scored(df, lm.fit(df, labels)).collect()), key=str)
    want = sorted(plain(rows, target), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        if w[1]:
            assert abs(g[2] - w[2]) < 1e-5 and abs(g[3] - w[3]) < 1e-5 and abs(g[4] - (g[2] - g[3])) < 1e-12
        else:
            assert g[2:] == (None, None, None)
    assert lm.scored(df.limit(0), lm.fit(df.limit(0), labels)).count() == 0
    uniform = lm.scored(df, lm.fit(df, labels.limit(0))).where("n_words > 0").collect()
    assert max(r.target_loss for r in uniform) - min(r.target_loss for r in uniform) < 1e-6


def test_good_documents_score_lower(spark):
    got = {r.doc_id: r.score for r in op7_language_model(spark, SF).collect()}
    labels = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if got.get(r.doc_id) is not None]
    mean = lambda q: sum(s for s, y in labels if y == q) / sum(y == q for _, y in labels)
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count() and mean(1) < mean(0)


def test_many_words_and_pairs_count_exactly(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 500)
    rng = random.Random(2)
    bag = [f"w{i}" for i in range(40_000)] * 2 + [f"s{i}" for i in range(40_000)] + ["the"] * 20_000
    rng.shuffle(bag)
    rows = [(i, " ".join(bag[i * 400:i * 400 + 400])) for i in range(len(bag) // 400)]
    target = set(range(0, len(rows), 3))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = lm.fit(df, spark.createDataFrame([(i,) for i in target], "doc_id long"))
    assert model["kinds"] == 40_001 and len(model["head"][0]) <= 500
    got = {r.doc_id: r for r in lm.scored(df, model).collect()}
    for d, n, t, b in plain(rows, target):
        assert got[d].n_words == n and abs(got[d].target_loss - t) < 1e-9 and abs(got[d].background_loss - b) < 1e-9
    assert max(r.target_loss for r in lm.scored(df, lm.fit(df, df.select("doc_id"), others=True)).collect()) == max(
        r.background_loss for r in lm.scored(df, lm.fit(df, df.select("doc_id"))).collect())
    new = spark.createDataFrame([(1, "the unseen the"), (2, "unseen1 unseen2")], "doc_id long, text string")
    both = lm.scored(new, lm.fit(df, df.limit(0), others=True)).orderBy("doc_id").collect()
    assert both[1].background_loss == math.log2(40_002) and both[0].target_loss == both[0].n_words * math.log2(40_002) / 3
