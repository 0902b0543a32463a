"""Benchmark matches against edit distances by brute force, and edge cases."""

import random
import re

from ledgerlens.llm import decontaminate as dc


def best_passage(item, doc):
    last = [0] * (len(doc) + 1)
    for i, a in enumerate(item):
        now = [i + 1]
        for j, b in enumerate(doc):
            now.append(min(last[j] + (a != b), last[j + 1] + 1, now[j] + 1))
        last = now
    return min(last)


def words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items):
    out = set()
    for d, text in docs:
        w = words(text)
        for i, t in items:
            x = words(t)
            if x and (w == x if len(x) < 3 else best_passage(x, w) <= len(x) // 5):
                out.add((d, i))
    return out


def test_matches_agree_with_brute_force(spark):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 5))) for _ in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, text(rng.choice([5, 6, 7, 8, 11, 15, 24, 40, 60]))) for i in range(30)]
    docs = []
    for d in range(240):
        body = text(rng.randint(20, 120))
        if d % 2:
            passage = list(items[d % 30][1])
            for _ in range(rng.randint(0, len(passage) // 4)):
                p = rng.randrange(len(passage))
                kind = rng.randrange(3)
                if kind == 0:
                    passage[p] = rng.choice(vocabulary)
                elif kind == 1:
                    passage.insert(p, rng.choice(vocabulary))
                elif len(passage) > 1:
                    del passage[p]
            at = rng.randrange(len(body))
            body[at:at] = passage
        docs.append((d, "\n".join([" ".join(body[:9]).title(), ", ".join(body[9:])])))
    items = [(i, " ".join(w)) for i, w in items]
    got = {(r.doc_id, r.item_id): r.edits for r in dc.matches(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute_force(docs, items)
    assert set(got) <= want
    assert len(got) >= 0.98 * len(want)
    by_id, by_item = dict(docs), dict(items)
    assert all(e == best_passage(words(by_item[i]), words(by_id[d])) for (d, i), e in got.items())


def test_edge_cases(spark):
    long_item = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10"
    items = [(1, long_item), (1, long_item), (2, long_item.upper()), (None, "Yes, no!"), (3, None), (4, ""), (5, "  ")]
    docs = [(1, None), (2, ""), (3, "yes no"), (4, "yes no yes"), (None, "x " * 20000 + long_item + " y" * 5), (5, long_item),
            (5, long_item), (6, "clean words of its own")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "text as item_id", "doc_id as c0")
    got = sorted(((r.doc_id, r.item_id, r.edits, r.start_word) for r in dc.matches(df, bench).collect()), key=str)
    assert got == sorted([(3, None, 0, 0), (None, 1, 0, 20000), (None, 2, 0, 20000), (5, 1, 0, 0), (5, 2, 0, 0), (5, 1, 0, 0),
                          (5, 2, 0, 0)], key=str)
    kept = dc.clean(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6]
    assert dc.matches(df.limit(0), bench).count() == 0
    assert dc.matches(df, bench.limit(0)).count() == 0 and dc.clean(df, bench.limit(0)).count() == len(docs)


def test_short_items_match_inside_longer_documents(spark):
    items = [(1, "What is it?"), (2, "the capital of France"), (3, "a b c d e f g"), (4, "of France"), (5, "b"), (6, "IS it what")]
    docs = [(1, "so what is IT, then " * 3), (2, "name the capital of france"), (3, "x a b c d e f g"), (4, "a b c d e f h g"),
            (5, "OF france"), (6, "what is"), (7, "it what is"), (8, "the capital"), (9, "of France again"), (10, "B"), (11, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.edits, r.start_word) for r in dc.matches(df, bench).collect())
    assert got == [(1, 1, 0, 1), (2, 2, 0, 1), (3, 3, 0, 1), (4, 3, 1, 0), (5, 4, 0, 0), (10, 5, 0, 0)]
    assert sorted(r.doc_id for r in dc.clean(df, bench).collect()) == [6, 7, 8, 9, 11]
    # without the rule on one and two words they match wherever they stand
    anywhere = {(r.doc_id, r.item_id) for r in dc.matches(df, bench, whole=1).collect()}
    assert anywhere == {(d, i) for d, i, *_ in got} | {(2, 4), (9, 4), (3, 5), (4, 5)}
