"""Hulls and candidates where most points lie inside: same results, little work a point."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators import testset


@pytest.mark.parametrize("kind", ["even", "grid", "line", "far", "odd"])
def test_hull_grows_by_points_beyond_it(monkeypatch, kind):
    """The same hull as that of all points at once; points inside the hull so far are not sorted again."""
    rng = np.random.default_rng(4)
    points = {
        "even": rng.uniform(0, 1000, (40_000, 2)),
        "grid": rng.integers(0, 60, (40_000, 2)) / 100.0,
        "line": np.repeat(rng.uniform(0, 9, (40_000, 1)), 2, 1),
        "far": rng.uniform(0, 100, (40_000, 2)) + [6.9e5, 5.3e6],
        "odd": np.concatenate([rng.uniform(0, 10, (39_998, 2)), [[np.nan, 1.0], [4.0, np.nan]]]),
    }[kind]
    whole, seen = testset.hull_of(points), []

    def counted(rows, hull_of=testset.hull_of):
        seen.append(len(rows))
        return hull_of(rows)

    monkeypatch.setattr(testset, "hull_of", counted)
    kept = np.zeros((0, 2))
    for at in range(0, len(points), 256):
        kept = testset.grown(kept, points[at : at + 256])
    assert kept.tolist() == whole.tolist()
    if kind in ("even", "far", "odd"):
        assert sum(seen) < len(points) / 5


def test_candidates_are_those_inside_or_touching(spark):
    """Against plain Python; a footprint without a place, a centroid of NaN, is inside nothing."""
    rng = random.Random(7)
    hull = [(0.0, 2.0), (8.0, 0.0), (10.0, 9.0), (3.0, 10.0)]
    box = lambda name, x, y: (name, float(x), float(y), x + 1.0, y + 1.0, x + 0.5, y + 0.5)
    rows = [box(f"u{i}", rng.uniform(-4, 14), rng.uniform(-4, 14)) for i in range(300)] + [("nowhere", -50.0, -50.0, -49.0, -49.0, math.nan, math.nan)]
    test = [box("t0", 9.5, 8.5), box("t1", -2.0, -2.0)]
    columns = "image_name string, x0 double, y0 double, x1 double, y1 double, centroid_x double, centroid_y double"
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in hull))
    found = testset.candidates(spark.createDataFrame(rows, columns), spark.createDataFrame(test, columns), spark.range(1).select(ring.alias("hull")))
    inside = lambda x, y: all((b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) > 0 for a, b in zip(hull, hull[1:] + hull[:1], strict=True))
    near = lambda r: any(r[1] <= t[3] and t[1] <= r[3] and r[2] <= t[4] and t[2] <= r[4] for t in test)
    expected = sorted(r[0] for r in rows if inside(r[5], r[6]) or near(r))
    assert sorted(r.image_name for r in found.collect()) == expected and 30 < len(expected) < 300
    assert found.columns == columns.replace(" string", "").replace(" double", "").split(", ")
