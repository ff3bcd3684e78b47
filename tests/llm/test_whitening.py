"""Whitening against whole numbers in plain Python and eigenvectors of a dense solver."""

from __future__ import annotations

import math

import numpy as np
import pytest

from lossline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, c0 double, whitened int"


def expected(vectors, most=16, scale=64, shift=1_000_000):
    """n, deviations, whitened and explained of vectors of one length."""
    x = [[math.floor(float(np.float32(c)) * scale) + shift for c in v] for v in vectors]
    distinct = sorted(set(map(tuple, x)))
    n = len(distinct)
    sums = [sum(column) for column in zip(*distinct)]
    deviation = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * v - s) / n for v, s in zip(row, sums)] for row in distinct])
    values, components = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:most]
    away = np.array([[(n * v - s) / n for v, s in zip(row, sums)] for row in x])
    return n, deviation, away @ components[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def same(got, want, digits=1e-9):
    """Equal but for the sign of each component."""
    got = np.array(got, float)
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got * sign - want).max() < digits


def vectors(seed, n, width):
    draw = np.random.default_rng(seed)
    base = draw.standard_normal((n, width)) * np.linspace(0.5, 3, width) @ np.linalg.qr(draw.standard_normal((width, width)))[0]
    return [[float(np.float32(c)) for c in row] for row in base]


@pytest.mark.parametrize("width", [3, 24])
def test_against_a_dense_solver(spark, width):
    held = vectors(width, 300, width)
    held += held[:40] + [held[7]] * 100  # copies weigh nothing
    rows = [(i, v, None, "x", 0.5, 3) for i, v in enumerate(held)]
    found, model = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert found.columns == ["vec_id", "embedding", "label", "x", "c0", "whitened", "deviation", "whitened"]
    got = sorted(tuple(r) for r in found.drop("embedding", "label").toDF("vec_id", "x", "c0", "w", "deviation", "whitened").collect())
    n, deviation, white, explained = expected(held)
    assert model.n == n == 300 and [int(r[4]) for r in got] == deviation
    same([r[5] for r in got], white)
    assert np.abs(model.values / model.trace - explained).max() < 1e-12 and model.identity_error < 1e-9


def test_awkward_rows(spark):
    held = vectors(1, 50, 4)
    bad = [None, [], [1.0, None, 2.0, 3.0], [1.0, float("nan"), 0.0, 0.0], [1.0, float("inf"), 0.0, 0.0], [1e30, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, None, "x", 0.5, 3) for i, v in enumerate(held)]
    rows += [(None, held[3], 1, None, None, None)] * 2 + [(100 + i, v, None, "x", 0.5, 3) for i, v in enumerate(bad)]
    found, model = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    got = found.select("vec_id", "deviation").collect()
    n, deviation, _, _ = expected(held)
    assert model.n == n == 50
    want = list(enumerate(deviation)) + [(None, deviation[3])] * 2
    assert sorted(((r[0], int(r[1])) for r in got), key=str) == sorted(want, key=str)


def test_nothing_to_fit(spark):
    found, model = whitening.whiten(spark.createDataFrame([], SCHEMA))
    assert model is None and found.count() == 0
    found, model = whitening.whiten(spark.createDataFrame([(1, None, 1, None, None, None)], SCHEMA))
    assert model is None and found.count() == 0
    same_ones = spark.createDataFrame([(i, [1.0, 2.0], 1, "x", 0.5, 3) for i in range(5)], SCHEMA)
    found, model = whitening.whiten(same_ones)
    assert model.n == 1 and model.identity_error is None
    assert [(int(r[0]), r[1]) for r in found.toDF(*"abcdefgh").select("g", "h").collect()] == [(0, [None, None])] * 5


def test_a_direction_without_variance(spark):
    held = [[a, b, a + b] for a, b in np.random.default_rng(2).integers(-9, 9, (80, 2)).astype(float).tolist()]
    found, model = whitening.whiten(spark.createDataFrame([(i, v, 1, "x", 0.5, 3) for i, v in enumerate(held)], SCHEMA))
    white = [r[0] for r in found.toDF(*"abcdefgh").select("h").collect()]
    assert all(row[2] is None and None not in row[:2] for row in white) and model.identity_error < 1e-9


def test_large_numbers(spark):
    held = [[1e9 * i, -3e8 * i * i, 7.0] for i in range(60)] + [[4e13, 0.0, -4e13]]
    found, model = whitening.whiten(spark.createDataFrame([(i, v, 1, "x", 0.5, 3) for i, v in enumerate(held)], SCHEMA))
    n, deviation, _, _ = expected(held)
    got = {r[0]: int(r[1]) for r in found.toDF(*"abcdefgh").select("a", "g").collect()}
    assert got == dict(enumerate(deviation))


def test_deviations_by_limbs():
    draw = np.random.default_rng(5)
    x = draw.integers(-(1 << 30), 1 << 30, (50, 6))
    for n in (1, 3, 12_345, 1 << 20, 1 << 40):
        sums = [int(v) for v in draw.integers(-(1 << 20), 1 << 20, 6)]
        model = whitening.Whitening(n, sums, np.zeros((6, 0)), np.zeros(0), 0.0)
        assert model.deviation(x) == [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]


def matrix(values, seed=0):
    x = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0].astype(np.longdouble)
    x = whitening._orthonormal(x)
    made = (x * np.array(values, np.longdouble)) @ x.T
    return (made + made.T) / 2, x


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 5, 40),
        np.r_[1, 1 + 1e-9, 1 + 2e-9, 1 + 1e-8, np.linspace(2, 3, 20)],
        1 + 1e-7 * np.arange(30),
        np.random.default_rng(1).uniform(1, 1.0001, 64),
        np.r_[1e-9, 1e-6, 1e-3, 1, 1000],
    ],
)
def test_close_eigenvalues(values):
    """Vectors that float32, or a dense solver in doubles, cannot tell apart."""
    made, x = matrix(values)
    found, components = whitening.eigen(made)
    order = np.argsort(-values)
    assert np.abs(found - values[order]).max() < 1e-15 * values.max()
    assert np.abs((components * x[:, order]).sum(axis=0)).min() > 1 - 1e-15


def test_equal_eigenvalues():
    """Any orthonormal vectors of the space do."""
    for values in (np.r_[np.ones(10), np.full(5, 2.0), np.linspace(3, 4, 9)], np.zeros(4), np.r_[np.zeros(5), 1 + np.arange(6) * 1e-13, 2], np.ones(7)):
        made, _ = matrix(values, 1)
        found, components = whitening.eigen(made)
        assert np.abs(made @ components - components * found).max() < 1e-16 * max(1, values.max())
        assert np.abs(components.T @ components - np.eye(len(values))).max() < 1e-16


def test_query(spark, data):
    from lossline.llm import queries

    rows = spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()
    held = [(r[0], r[1]) for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    n, deviation, white, explained = expected([v for _, v in held])
    found = queries.queries()["op13_whitening"](spark, data).collect()
    assert len(found) == len(held) * min(16, white.shape[1])
    at = {vec_id: i for i, (vec_id, _) in enumerate(held)}
    got = np.zeros(white.shape)
    for r in found:
        i = at[r.vec_id]
        got[i, r.component - 1] = r.whitened
        assert (r.n, r.deviation) == (n, deviation[i]) and r.identity_error < 1e-9
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
    same(got, white, 1e-7)
