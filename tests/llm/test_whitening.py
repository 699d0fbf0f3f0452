"""Operator 13 against numpy's eigenvectors and exact integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from skyloom.llm import whitening
from skyloom.llm.queries import QUERIES
from skyloom.session import table

SCHEMA = "vec_id long, embedding array<float>"


def _brute(vectors: list[list[float]], count: int = 8):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(0)
    y = (x * n - sums).astype(float) / n
    covariance = y.T @ y / n
    values, found = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:count]
    deviation = [int(sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))) for row in x]
    return n, deviation, y @ found[:, order] / np.sqrt(values[order]), values[order] / np.trace(covariance)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_is_brute_force(spark, sf):
    given = table(spark, f"/root/testdata/{sf}", "embeddings").collect()
    n, deviation, whitened, explained = _brute([r.embedding for r in given])
    place = {r.vec_id: i for i, r in enumerate(given)}
    rows = QUERIES["op13_whitening"](spark, f"/root/testdata/{sf}").collect()
    assert len(rows) == 8 * n == 8 * len(place)
    got = np.zeros((n, 8))
    for r in rows:
        assert r.n == n and r.deviation == deviation[place[r.vec_id]] and r.identity_error < 1e-9
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-10
        got[place[r.vec_id], r.component - 1] = r.whitened
    signs = np.sign((got * whitened).sum(0))
    assert np.abs(got * signs - whitened).max() < 1e-8


@pytest.mark.parametrize("shape", ["random", "clustered", "equal", "steep", "low rank"])
def test_contours_find_all_eigenpairs(shape):
    rng = np.random.default_rng(3)
    n = 40
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    values = {
        "random": rng.random(n) * 100,
        "clustered": np.concatenate([50 + 1e-7 * rng.random(6), rng.random(n - 6)]),
        "equal": np.concatenate([np.full(12, 7.0), rng.random(n - 12)]),
        "steep": 10.0 ** -np.arange(n / 4).repeat(4)[:n],
        "low rank": np.concatenate([rng.random(5) + 1, np.zeros(n - 5)]),
    }[shape]
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    for shift in (0.5, 3.0, 60.0):
        assert whitening.inertia(matrix, shift) == (values > shift).sum()
    found, vectors = whitening.largest(matrix, 8)
    expected = np.sort(values)[::-1][: 5 if shape == "low rank" else 8]
    assert np.allclose(found, expected, rtol=1e-9, atol=1e-13)
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-11 * values.max()


def test_missing_pairs_are_an_error():
    with pytest.raises(ArithmeticError):
        whitening.contour(np.diag([1.0, 2.0, 3.0]), 1.5, 3.5, 3)


def test_odd_rows(spark):
    good = [(1, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (None, [0.0, -1.0, 3.0]), (2, [5.0, 1.0, 1.0]), (3, [2.0, 2.0, -7.0])]
    bad = [(4, None), (5, [1.0, None, 2.0]), (6, [float("nan"), 1.0, 1.0]), (7, [float("inf"), 0.0, 0.0]), (8, []), (9, [1.0, 2.0]), (10, [3e38, 0.0, 0.0])]
    given = spark.createDataFrame([(*r, "w", "d", 4) for r in good + bad], f"{SCHEMA}, whitened string, x string, v int")
    model = whitening.fit(given)
    rows = whitening.whiten(given, model).collect()
    n, deviation, whitened, _ = _brute([v for _, v in good], 3)
    assert sorted((r.vec_id or 0, r.deviation) for r in rows) == sorted((i or 0, d) for (i, _), d in zip(good, deviation, strict=True))
    assert model.n == n == 5 and {(r.x, r.v) for r in rows} == {("d", 4)}
    assert np.allclose(np.sort([np.abs(r.whitened) for r in rows], 0), np.sort(np.abs(whitened), 0))
    assert whitening.identity_error(whitening.whiten(given, model), model) < 1e-10


def test_no_spread_and_no_rows(spark):
    same = spark.createDataFrame([(i, [1.5, 2.5]) for i in range(4)], SCHEMA)
    model = whitening.fit(same)
    assert model.n == 4 and len(model.values) == 0
    assert [(r.deviation, r.whitened) for r in whitening.whiten(same, model).collect()] == [(0, [])] * 4
    assert whitening.identity_error(whitening.whiten(same, model), model) == 0.0
    none = same.limit(0)
    assert whitening.whiten(none, whitening.fit(none)).collect() == []


def test_deviations_past_a_long_are_null():
    x = np.array([[2**29, 0], [0, 1]])
    found = whitening._deviations(x, 10_000_000, np.array([2**29, 1], dtype=object)).to_pylist()
    assert found[0] is None and found[1] == 2**58 + (10_000_000 - 1) ** 2
