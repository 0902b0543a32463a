"""Codes against brute force in Python integers: every distance, every round."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerlens.llm import vector_codes as vc
from ledgerlens.llm.op11_vector_codes import op11_vector_codes
from ledgerlens.llm.scratch import Scratch

SF = "/root/testdata/sf0.001"


def plain(rows, parts, entries, rounds):
    """rows: (id, vector); codes and errors by row, and the codebooks."""
    rows = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))
    w = len(rows[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v in rows]
    books = [[cut[k][p] for k in order[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(c[p], books[p])[1] for c in cut]
            moved = []
            for i, e in enumerate(books[p]):
                points = [c[p] for c, o in zip(cut, own) if o == i]
                moved.append([sum(x) // len(points) for x in zip(*points)] if points else e)
            books[p] = moved
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    return ["".join(f"{i:02x}" for _, i in f) for f in found], [sum(d for d, _ in f) for f in found], books


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code string, error string")


def check(spark, rows, parts=2, entries=7, rounds=3, block=16):
    whole = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    codes, errors, books = plain([r[:2] for r in whole], parts, entries, rounds)
    blocks, got = vc.fit(frame(spark, rows), parts, entries, rounds, block)
    assert got.tolist() == books
    out = vc.with_label_error(vc.coded(blocks, got), Scratch(spark, "test"))
    labels = {}
    for r, e in zip(whole, errors):
        labels[r[2]] = labels.get(r[2], 0) + e
    assert sorted(map(tuple, out.select("vec_id", "label", "code", "error", "label_error").collect()), key=str) == sorted(
        ((r[0], r[2], c, e, labels[r[2]]) for r, c, e in zip(whole, codes, errors)), key=str)


def test_edge_cases(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, 0.25, 0.5]) + rng.random() * 0.01 for _ in range(4)], i % 3 or None, "x", None) for i in range(90)]
    rows += rows[:20] + [(None, rows[0][1], 1, None, None), (7, rows[3][1], 9, "y", "z")]
    rows += [(i, [0.5] * 4, 1, "", "") for i in range(200, 240)]  # one vector, many rows
    rows += [(500, None, 1, "", ""), (501, [1.0, None, 0.0, 0.0], 1, "", ""), (502, [float("nan")] * 4, 1, "", ""),
             (503, [0.0, 0.0, float("-inf"), 0.0], 1, "", "")]
    rng.shuffle(rows)
    check(spark, rows)
    check(spark, rows[:3], entries=256)
    assert vc.fit(frame(spark, rows).limit(0)) is None
    assert vc.fit(frame(spark, [(1, None, 1, "", "")])) is None


def test_refused(spark):
    for vectors in ([[1.0] * 4, [1.0] * 6], [[1.0] * 5], [[]], [[1e9] * 4]):
        with pytest.raises(Exception, match="components|divide|too large"):
            vc.fit(frame(spark, [(i, v, 1, "", "") for i, v in enumerate(vectors)]), 2)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(1, 40), st.integers(1, 6), st.integers(0, 2**32 - 1), st.integers(1, 60))
def test_walk_finds_the_nearest(n, entries, width, seed, spread):
    rng = np.random.default_rng(seed)
    points, book = rng.integers(-spread, spread + 1, (n, width)), rng.integers(-spread, spread + 1, (entries, width))
    gaps = ((points[:, None] - book[None]) ** 2).sum(2)
    tree, books = vc.grown(points, 4), vc.grown(book, 1)
    want = gaps.argmin(1)  # the first of equals
    assert (vc.assigned(tree, books) == want).all()
    count, total = vc.moved(tree, books)
    assert (count == np.bincount(want, minlength=entries)).all()
    assert all((total[i] == points[want == i].sum(0)).all() for i in range(entries))


def test_clustered_points_go_as_whole_nodes():
    rng = np.random.default_rng(3)
    centres = rng.integers(-5000, 5000, (32, 8))
    tree = vc.grown(centres[rng.integers(0, 32, 4096)] + rng.integers(-3, 4, (4096, 8)), 16)
    whole, row, _ = vc.walk(tree, vc.grown(centres, 1))
    assert sum(int(np.diff(tree.borders[level])[node].sum()) for level, node, _ in whole) + len(row) == 4096
    assert len(row) < 1024


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    codes, errors, _ = plain(rows[:], vc.PARTS, vc.ENTRIES, vc.ROUNDS)
    got = {r.vec_id: (r.code, r.error) for r in op11_vector_codes(spark, SF).collect()}
    assert got == {i: (c, e) for (i, _), c, e in zip(rows, codes, errors)}
