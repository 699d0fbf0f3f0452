"""The distributed fit of the rates against a dense solver of nonnegative least squares."""

from __future__ import annotations

import warnings

import numpy as np
import pytest

from skyloom.llm import mixing


def nonnegative(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |ax - b|, by the active sets of Lawson and Hanson."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(10 * a.shape[1]):
        slope = a.T @ (b - a @ x)
        if free.all() or slope[~free].max() <= 1e-9 * np.abs(a.T @ b).max():
            break
        free[np.flatnonzero(~free)[slope[~free].argmax()]] = True
        while True:
            z = np.zeros_like(x)
            z[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if (z[free] > 0).all():
                break
            low = free & (z <= 0)
            x = x + (x[low] / (x[low] - z[low])).min() * (z - x)
            free &= x > 1e-12
            x[~free] = 0
        x = z
    return x


def corpus(size: int, alike: int) -> list[tuple[int, str, str]]:
    """Domains with words of their own and some of their neighbour's; the last `alike` ones share all words."""
    words = [f"{chr(0x4E00 + 97 * d)}{chr(0x5E00 + 89 * d)}" for d in range(size + 1)]
    rows = []
    for d in range(size):
        own = min(d, size - alike) if alike else d
        rows += [(10 * d + i, " ".join([words[own]] * (20 + 3 * i) + [words[own + 1]] * (4 * i)), f"d{d:02}") for i in range(10)]
    return rows


@pytest.mark.parametrize(("size", "alike"), [(4, 0), (20, 0), (80, 0), (4, 2), (20, 3)])
def test_fit_is_as_close_as_a_dense_solver(spark, size, alike):
    rows = corpus(size, alike)
    have = np.zeros(size)
    for _, text, domain in rows:
        have[int(domain[1:])] += len(text.split())
    targets = {f"d{d:02}": have[d] * (0.8 if d % 2 else 1.3) for d in range(size)}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        model = mixing.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), targets=targets)
    weights = mixing.posteriors([t for _, t, _ in rows], model) * np.array([len(t.split()) for _, t, _ in rows])[:, None]
    goal = np.array([targets[d] for d in model.domains])
    # rates are not unique, but the tokens nearest to the targets are
    nearest = weights.T @ nonnegative(weights.T, goal)
    found = weights.T @ mixing.rates(weights, model.steps)[0]
    assert np.allclose(found, model.expected, rtol=1e-6)
    assert np.linalg.norm(found - goal) <= np.linalg.norm(nearest - goal) + 0.005 * np.linalg.norm(goal)
    assert np.abs(found - nearest).max() <= 0.01 * goal.max()
    assert bool(model.missed) == (alike > 0)
