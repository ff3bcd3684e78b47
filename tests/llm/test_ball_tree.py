"""Exact search against numpy."""

from __future__ import annotations

import random

import numpy as np

from lossline.llm import ball_tree
from lossline.llm.ball_tree import BallTree

ROWS = "vec_id long, embedding array<float>, label int, rank int, VEC_ID string"


def expected(vectors, queries, k):
    out = []
    for own, q in queries:
        scores = {}
        for i, v in vectors:
            if i != own and len(v) == len(q):
                s = sum(int(a) * int(b) for a, b in zip(q, v))
                scores[i] = max(scores.get(i, s), s)
        ordered = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(own, n + 1, i, s) for n, (i, s) in enumerate(ordered)]
    return sorted(out)


def test_small_trees(spark, monkeypatch):
    monkeypatch.setattr(ball_tree, "TREE_BYTES", 4000)
    monkeypatch.setattr(ball_tree, "BLOCK", 7)
    monkeypatch.setattr(ball_tree, "LEAF", 5)
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(5, 8))
    points = centres[draw.integers(0, 5, 400)] + 0.2 * draw.normal(size=(400, 8))
    points[50:90] = points[50]  # ties
    rows = [(i, [float(np.float32(x)) for x in p]) for i, p in enumerate(points)]
    rows += [(1000, [1.0, 2.0]), (1001, [0.5, -2.0]), (1002, []), (1003, []), (1004, [7.0, 1.0, 1.0])]
    odd = [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 8), (2003, [float("inf")] + [0.0] * 7), (None, [0.0] * 8)]
    table = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows + odd], ROWS)
    vectors = ball_tree.usable(table)
    plain = [(i, [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v]) for i, v in rows]
    assert sorted((r.vec_id, list(r.v)) for r in vectors.collect()) == sorted(plain)
    for k in (3, 500):
        found = ball_tree.search(vectors, vectors.filter("vec_id % 20 = 0 OR vec_id >= 1000"), k)
        asked = [(i, v) for i, v in plain if i % 20 == 0 or i >= 1000]
        assert sorted(map(tuple, found.collect())) == expected(plain, asked, k)


def test_repeated_and_no_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [2.0, 0.0])]
    vectors = ball_tree.usable(spark.createDataFrame([(*r, 1, 1, "") for r in rows], ROWS))
    plain = [(i, [int(x * 1024) for x in v]) for i, v in rows]
    found = sorted(map(tuple, ball_tree.search(vectors, vectors.filter("vec_id = 0"), 10).collect()))
    assert found == [(0, 1, 2, 2 * 1024**2), (0, 2, 1, 1024**2)] and plain
    assert ball_tree.search(vectors.limit(0), vectors.limit(0)).count() == 0


def test_large_components():
    draw = random.Random(1)
    for size in (2**20, 2**30, 2**40):
        rows = np.array([[draw.randint(-size, size) for _ in range(4)] for _ in range(300)], np.int64)
        tree = BallTree.load(BallTree.build(np.arange(300), rows).dump())
        q = rows[7]
        ids, scores = tree.search(7, q, 5, np.zeros(0, np.int64), np.zeros(0, np.int64))
        exact = [min(max(sum(int(a) * int(b) for a, b in zip(q, r)), -(2**63)), 2**63 - 1) for r in rows]
        want = sorted((i for i in range(300) if i != 7), key=lambda i: (-exact[i], i))[:5]
        assert ids.tolist() == want and scores.tolist() == [exact[i] for i in want]


def test_visits_few_leaves():
    draw = np.random.default_rng(2)
    rows = (draw.normal(size=(4000, 3)) * 1000).astype(np.int64)
    tree, seen = BallTree.build(np.arange(4000), rows), []
    plain = tree.scores
    tree.scores = lambda a, b, q: seen.append(b - a) or plain(a, b, q)
    tree.search(-1, rows[0], 10, np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert sum(seen) < 1500
