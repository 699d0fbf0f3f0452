"""Operators at sizes, widths and skews that one task or one level of cells would not bear, against plain Python."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from skyloom.operators import analytics, slicing, spatial


@pytest.mark.parametrize("kind", ["even", "odd", "ties", "tailed", "single"])
def test_medians_by_selection(spark, kind):
    """No task may hold more than 10 values; ranges narrow down to one value or ten."""
    rng = random.Random(1)
    values = {
        "even": [rng.uniform(-5, 5) for _ in range(2000)],
        "odd": [rng.uniform(-5, 5) for _ in range(2001)],
        "ties": [float(rng.choice([1, 1, 1, 2, 3])) for _ in range(1500)],
        "tailed": [10.0 ** rng.uniform(-9, 9) for _ in range(1500)],
        "single": [4.5],
    }[kind]
    frame = spark.createDataFrame([(v, -v, None) for v in values], "a double, b double, c double")
    assert analytics.medians(frame, ["a", "b", "c"], one_task=10) == {"a": statistics.median(values), "b": -statistics.median(values), "c": None}


def test_summary_is_the_same_either_way(spark):
    rng = random.Random(6)
    boxes = analytics.pixel_boxes(spark.createDataFrame([(rng.random(), rng.random()) for _ in range(999)], "bw double, bh double"))
    assert analytics.area_summary(boxes, one_task=50).first() == analytics.area_summary(boxes).first()


@pytest.mark.parametrize("size", [64, 65, 115, 116, 500, 100_000])
def test_reached_tiles_are_those_of_the_list(spark, size):
    tile, stride = 64, 51
    rng = random.Random(size)
    every = [*range(0, size - tile, stride), size - tile]
    rows = [(lo, lo + rng.choice([0.0, 0.5, 3.0, 51.0, 200.0]), float(size)) for lo in [rng.uniform(-5, size) for _ in range(150)] + [float(o) for o in every[:20]] + [o + 64.0 for o in every[:20]]]
    frame = spark.createDataFrame(rows, "lo double, hi double, w double")
    for r in frame.select("*", slicing._reached("lo", "hi", "w", tile, stride).alias("o")).collect():
        assert sorted(r.o) == [o for o in every if r.lo < o + tile and r.hi > o]


def test_one_large_footprint_among_small_ones(spark):
    """A side of 10 km beside sides of a metre: each row is dealt to a few cells of each level, and every pair is found once."""
    rng = random.Random(4)
    box = lambda side: (x := rng.uniform(-5e3, 5e3), y := rng.uniform(-5e3, 5e3), x + side * rng.uniform(0.5, 1), y + side * rng.uniform(0.5, 1))
    left = [(i, *box(rng.choice([1, 1, 1, 1, 30, 700]))) for i in range(400)] + [(900, -5e3, -5e3, 5e3, 5e3)]
    right = [(i, *box(rng.choice([1, 2, 2, 2, 90, 2000]))) for i in range(400)] + [(901, 0.0, -4e3, 0.0, 4e3)]
    a, b = (spark.createDataFrame(rows, "id int, x0 double, y0 double, x1 double, y1 double") for rows in (left, right))
    rows = spatial.box_pairs(a, b, 4.0).select("l_id", "r_id").collect()
    expected = {(p[0], q[0]) for p in left for q in right if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]}
    assert len(rows) == len(expected) and {tuple(r) for r in rows} == expected
    assert any(p == 900 for p, _ in expected) and any(q == 901 for _, q in expected)
    dealt = a.withColumn("level", spatial._level(4.0))
    for level in (r.level for r in dealt.select("level").distinct().collect()):
        per_row = spatial.gridded(dealt.where(F.col("level") == level), 4.0 * 2.0**level).groupBy("id").count()
        assert per_row.agg(F.max("count")).first()[0] <= 36
