"""Test sets are isolated from training and buffer in one semi-join that reads the pool's rows once."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from skyloom.functions import ring
from skyloom.operators import spatial, testset

BOX = "image_name string, x0 double, y0 double, x1 double, y1 double"


def _rows(spark, rng, prefix, n, width, large=()):
    """Boxes of a side up to 5, and a few large ones."""
    rows = []
    for i, side in enumerate([5.0] * n + list(large)):
        x, y = rng.uniform(0, width), rng.uniform(0, 60)
        rows.append((f"{prefix}{i}", x, y, x + side * rng.uniform(0.5, 1), y + side * rng.uniform(0.5, 1)))
    return spark.createDataFrame(rows, BOX)


def _ringed(rows):
    """The lower left halves of the boxes."""
    at = lambda x, y: ring.point(F.col(x), F.col(y))
    return rows.withColumn("ring", F.array(at("x0", "y0"), at("x1", "y0"), at("x0", "y1")))


@pytest.mark.parametrize("ringed", ["none", "all", "train", "buffer"])
def test_isolated_is_two_anti_joins(spark, monkeypatch, ringed):
    rng = random.Random(12)
    pool = _rows(spark, rng, "p", 250, 90, (40,)).unionByName(_rows(spark, rng, "p", 3, 90))  # three names stand twice
    train, buffer = _rows(spark, rng, "t", 60, 40, (50,)), _rows(spark, rng, "b", 25, 90)
    if ringed != "none":
        pool = _ringed(pool)
    train, buffer = (_ringed(df) if ringed in ("all", name) else df for df, name in ((train, "train"), (buffer, "buffer")))

    gone = set()
    for other in (train, buffer):
        pairs = spatial.box_pairs(pool, other, 8.0)
        if "ring" in pool.columns and "ring" in other.columns:
            pairs = pairs.where(ring.intersects(F.col("l_ring"), F.col("r_ring")))
        gone.add(frozenset(r.l_image_name for r in pairs.select("l_image_name").distinct().collect()))
    expected = sorted(r.image_name for r in pool.collect() if not any(r.image_name in names for names in gone))

    calls = []

    def counted(*args, touching=testset.touching, **kwargs):
        calls.append(args)
        return touching(*args, **kwargs)

    monkeypatch.setattr(testset, "touching", counted)
    found = testset.isolated(pool, train, buffer)
    assert sorted(r.image_name for r in found.collect()) == expected and 20 < len(expected) < 250
    assert all(gone) and len(gone) == 2
    assert len(calls) == (1 if ringed in ("none", "all") else 2)


def test_pool_is_read_once(spark):
    """A pool with a long lineage is made once, however often the rounds read it."""
    rng = random.Random(13)
    read = spark.sparkContext.accumulator(0)

    def count(name):
        read.add(1)
        return name

    pool = _rows(spark, rng, "p", 300, 90).withColumn("image_name", F.udf(count)("image_name"))
    assert 0 < testset.isolated(pool, _rows(spark, rng, "t", 60, 40), _rows(spark, rng, "b", 25, 90)).count() < 300
    assert read.value == 300


def test_distillation_writes_what_it_reads(spark, sf_dir, monkeypatch):
    """The allocation is written once, without the columns that no layer needs."""
    from skyloom.plans import queries

    written = []

    def noted(df):
        written.append(df.columns)
        return df

    monkeypatch.setattr(queries, "materialize", noted)
    assert queries.distillation_pool_size(spark, sf_dir).first().n > 0
    assert written == [["image_name", "campaign", "split", *spatial.BOUNDS]]
