"""DartMinHash classes against all pairs by brute force, and edge cases."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerlens.llm import near_dup


def shingle_counts(text):
    w = (text or "").replace("\t", " ").split()
    if not w:
        return Counter()
    n = min(5, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def similarity(a, b):
    inter = sum(min(c, b[s]) for s, c in a.items() if s in b)
    return inter / (sum(a.values()) + sum(b.values()) - inter)


def brute_force(rows, bound=0.8):
    sets = {i: shingle_counts(t) for i, t in rows}
    near = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            near[g].add(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    seen = set()
    for group in near.values():
        for i in group:
            for j in group:
                if i < j and (i, j) not in seen:
                    seen.add((i, j))
                    if similarity(sets[i], sets[j]) >= bound:
                        a, b = sorted((root(i), root(j)))
                        parent[b] = a
    return {i: root(i) for i in sets}


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    rows = []
    for i in range(60):
        base = [word() for _ in range(rng.choice([3, 6, 40, 150]))]
        rows.append(" ".join(base))
        for edits in (0, 1, 2, 4, 8):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    # a chain: each text near the next, the ends far apart
    chain = [word() for _ in range(100)]
    for i in range(12):
        rows.append(" ".join(chain[i * 4:] + [word() for _ in range(i * 4)]))
    return list(enumerate(rows))


def test_classes_match_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in near_dup.classes(df).collect()}
    assert got == brute_force(rows)


def test_signature_agreement_estimates_weighted_similarity():
    rng = np.random.default_rng(0)
    elem = rng.integers(1, 2**63, 60).astype(np.uint64)
    a, b = rng.uniform(0.05, 3, 60), rng.uniform(0.05, 3, 60)
    exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    sig = near_dup.dart_signatures(np.repeat([0, 1], 60), np.tile(elem, 2), np.concatenate([a, b]), 2, 4000)
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.04


@pytest.mark.parametrize("few, holders", [(0, 16), (0, 2), (64, 16)])
def test_hot_bucket_with_one_common_passage(spark, few, holders):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(60)]
    rows = list(enumerate(" ".join(passage + [word() for _ in range(rng.choice([8, 30]))]) for _ in range(60)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = near_dup.Scratch(spark, "t")
    sk = scratch.write(near_dup.sketch(df), "sketch")
    links = near_dup.links(sk, df, scratch, few=few, holders=holders)
    comp = near_dup.components(links, scratch)
    placed = sk.join(comp, "node", "left").selectExpr("doc_id", "coalesce(comp, node) comp").collect()
    groups = defaultdict(list)
    for r in placed:
        groups[bytes(r.comp)].append(r.doc_id)
    assert {i: min(g) for g in groups.values() for i in g} == brute_force(rows)


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "one two", "x"), (3, "one two", "x"), (3, "one two", "x"),
            (4, " \t\n", "x"), (5, "w " * 30000, "x"), (6, "w " * 30000, "x"), (None, None, "x"), (7, "one two three", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string").withColumnRenamed("node", "class_id")
    got = sorted(((r.doc_id, r.class_id, r.class_size) for r in near_dup.classes(df).collect()), key=str)
    assert got == sorted([(1, 1, 1), (2, 2, 1), (None, 3, 3), (3, 3, 3), (3, 3, 3), (4, 4, 1), (5, 5, 2), (6, 5, 2),
                          (None, None, 1), (7, 7, 1)], key=str)
    kept = sorted((r.doc_id for r in near_dup.keep_one(df).collect()), key=str)
    assert kept == sorted([1, 2, 3, 4, 5, None, 7], key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.classes(empty).count() == 0 and near_dup.keep_one(empty).count() == 0


def test_hot_group_without_its_source_is_linear(spark, monkeypatch):
    """Near copies of a text that isn't there: several leads, yet each text emits its shingles once; classes as by all pairs."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for source in ([word() for _ in range(80)] for _ in range(2)):
        for _ in range(110):
            copy = list(source)
            for _ in range(rng.choice([1, 2, 3])):
                copy[rng.randrange(80)] = word()
            rows.append(" ".join(copy))
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    asked = []
    own = near_dup._own_shingles
    monkeypatch.setattr(near_dup, "_own_shingles", lambda pairs, texts: asked.append(pairs) or own(pairs, texts))
    scratch = near_dup.Scratch(spark, "t")
    sk = scratch.write(near_dup.sketch(df), "sketch")
    links = near_dup.links(sk, df, scratch, few=0, holders=4)
    assert asked
    for pairs in asked:
        assert pairs.groupBy("node").count().where("count > 1").isEmpty()
    comp = near_dup.components(links, scratch)
    placed = sk.join(comp, "node", "left").selectExpr("doc_id", "coalesce(comp, node) comp").collect()
    groups = defaultdict(list)
    for r in placed:
        groups[bytes(r.comp)].append(r.doc_id)
    assert {i: min(g) for g in groups.values() for i in g} == brute_force(rows)


def test_clashing_names_are_kept(spark):
    rows = [(1, "a b c d e f", "p", 5), (2, "a b c d e f", "q", 6), (None, "x y", "r", 7), (None, "x y", "s", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_hash string, text_hash_ int")
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1]
    assert {r.text_hash_ for r in kept.collect()} <= {5, 7, 8}
