"""Semi-joins of footprints that lie upon each other: same rows as all pairs, without making them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from skyloom.operators import spatial, stratify, testset

BOX = "k string, x0 double, y0 double, x1 double, y1 double"


def _box(rng, side, width, height):
    x, y = round(rng.uniform(0, width), 1), round(rng.uniform(0, height), 1)
    return x, y, round(x + side * rng.uniform(0.5, 1), 1), round(y + side * rng.uniform(0.5, 1), 1)


@pytest.mark.parametrize("closed", [True, False])
def test_touching_is_what_all_pairs_say(spark, closed):
    """Rows of several levels, keys that repeat, and cells of many rounds."""
    rng = random.Random(3)
    left = [(f"k{i % 350}", *_box(rng, rng.choice([1, 1, 1, 30]), 90, 20)) for i in range(400)]
    right = [(f"r{i}", *_box(rng, 1, 40, 9)) for i in range(400)] + [("far", 500.0, 500.0, 501.0, 501.0)]
    a, b = (spark.createDataFrame(rows, BOX) for rows in (left, right))
    meet = (lambda p, q: p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]) if closed else (lambda p, q: p[1] < q[3] and q[1] < p[3] and p[2] < q[4] and q[2] < p[4])
    expected = {p[0] for p in left if any(meet(p, q) for q in right)}
    found = [r.k for r in spatial.touching(a, b, "k", 4.0, closed, first=2).collect()]
    assert sorted(found) == sorted(expected) and 0 < len(expected) < 350
    assert spatial.touching(a, b.limit(0), "k", 4.0).count() == spatial.touching(a.limit(0), b, "k", 4.0).count() == 0


def test_rows_upon_each_other_try_few_partners(spark):
    """4,000 rows over 4,000 others make 16 million pairs, each row having thousands of partners; a row needs one."""
    rng = random.Random(5)
    left = [(f"l{i}", *_box(rng, 5, 4, 12)) for i in range(4000)]
    right = [(f"r{i}", *_box(rng, 5, 4, 4)) for i in range(4000)]
    a, b = (spark.createDataFrame(rows, BOX).repartition(4) for rows in (left, right))
    tried = spark.sparkContext.accumulator(0)

    def count(x):
        tried.add(1)
        return x is not None

    found = spatial.touching(a, b, "k", 8.0, where=F.udf(count, "boolean")("l_x0")).count()
    top = max(r[4] for r in right)
    assert 2000 < found < 4000 and found <= sum(p[2] <= top for p in left)
    assert tried.value < 20 * len(left)


@pytest.mark.parametrize(("limit", "closed"), [(0.0, False), (60.0, False), (0.0, True)])
def test_allocation_drops_the_rows_of_the_pairs(spark, closed, limit):
    rng = random.Random(8)
    rows = [(f"i{i}", *_box(rng, 5, 12, 12), "train" if i % 3 else "test") for i in range(600)]
    allocated = spark.createDataFrame(rows, BOX.replace("k ", "image_name ") + ", split string").withColumn("area_m2", (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    thinned = allocated.where("split = 'train' or x0 < 5")
    pairs = stratify.cross_split_pairs(thinned).collect()
    gone = {r.train_name for r in pairs if closed or r.overlap_pct > limit}
    kept = [r.image_name for r in stratify.allocation(thinned, limit, closed).collect()]
    assert sorted(kept) == sorted({r.image_name for r in thinned.collect()} - gone) and gone


def test_rows_of_one_file_are_tried_by_many_tasks(spark):
    """All left rows in one partition and near two cells, as tables sorted by place have them."""
    from pyspark import AccumulatorParam, TaskContext

    class Counts(AccumulatorParam):
        def zero(self, value):
            return {}

        def addInPlace(self, one, other):
            return {k: one.get(k, 0) + other.get(k, 0) for k in one | other}

    rng = random.Random(11)
    a, b = (spark.createDataFrame([(f"{i}", *_box(rng, 5, 8, 8)) for i in range(3000)], BOX).coalesce(1) for _ in "ab")
    tried = spark.sparkContext.accumulator({}, Counts())

    def never(x, y):
        tried.add({TaskContext.get().partitionId(): 1})
        return False

    near = F.abs(F.col("l_x0") - F.col("r_x0")) < 0.05
    assert spatial.touching(a, b, "k", 8.0, where=near & F.udf(never, "boolean")("l_x0", "r_x0")).count() == 0
    assert sum(tried.value.values()) > 1000 and max(tried.value.values()) < 0.6 * sum(tried.value.values())


def test_pairs_apart_are_the_pairs(spark):
    rng = random.Random(9)
    a, b = (spark.createDataFrame([(f"{i}", *_box(rng, rng.choice([2, 40]), w, 60)) for i in range(300)], BOX) for w in (90, 20))
    pairs = [sorted(tuple(r) for r in spatial.box_pairs(a, b, 4.0, apart=apart).select("l_k", "r_k").collect()) for apart in (True, False)]
    assert pairs[0] == pairs[1] and pairs[0]


def test_rings_upon_each_other(spark):
    """Triangles whose bounds meet all others' but that touch only some: every row tries until it hits or has tried all."""
    rng = random.Random(2)
    from skyloom.functions import ring

    def triangles(n, low):
        rows = []
        for i in range(n):
            x, y = rng.uniform(0, 3), rng.uniform(0, 3)
            rows.append((f"{i}", [(x, y), (x + 4, y), (x, y + 4)] if low else [(x + 4, y + 4), (x, y + 4), (x + 4, y)], x, y, x + 4, y + 4))
        return spark.createDataFrame(rows, "k string, ring array<struct<x:double,y:double>>, x0 double, y0 double, x1 double, y1 double")

    a, b = triangles(150, True), triangles(60, False)
    pairs = spatial.box_pairs(a, b, 8.0).where(ring.intersects(F.col("l_ring"), F.col("r_ring"))).select("l_k").distinct().collect()
    found = testset.exact_touching(a, b, "k", 8.0).collect()
    assert sorted(r.k for r in found) == sorted(r.l_k for r in pairs) and 0 < len(found)
