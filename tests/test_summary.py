"""Counts of leaks over odd names, without a join that sorts all rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from skyloom.operators import stratify
from skyloom.plans import queries


def test_summary_of_odd_names(spark):
    """Names that repeat, in one cohort or in several, and rows without a name, which never leak: the counts of with_leaks() and of plain Python."""
    rng = random.Random(12)
    rows = [(rng.choice([None, f"i{rng.randrange(150)}"]) if i % 9 == 0 else f"i{rng.randrange(150)}", x := rng.uniform(0, 60), y := rng.uniform(0, 60), x + 3, y + 3, 9.0, rng.choice(["train"] * 6 + ["val", "test"])) for i in range(260)]
    allocated = spark.createDataFrame(rows, "image_name string, x0 double, y0 double, x1 double, y1 double, area_m2 double, split string")
    initial = spark.range(300)
    meet = lambda p, q: p[1] < q[3] and q[1] < p[3] and p[2] < q[4] and q[2] < p[4]
    leaking = {p[0] for p in rows if p[6] == "train" and any(q[6] != "train" and meet(p, q) for q in rows)}
    assert None in leaking and any(r[0] in leaking and r[6] != "train" for r in rows)
    kept = [r for r in rows if r[0] is None or r[0] not in leaking]
    names, kept_names = ({r[0] for r in some if r[0] is not None} for some in (rows, kept))
    expected = (300, 40, len(names) - len(kept_names), len(kept_names), *(sum(r[6] == s for r in kept) for s in ("train", "val", "test")), len(kept_names) * 100.0 / 300)
    for flagged in (stratify.with_leak_rows(allocated), stratify.with_leaks(allocated)):
        assert tuple(stratify.summary(initial, flagged).first()) == expected
    empty = stratify.summary(initial.limit(0), stratify.with_leak_rows(allocated.limit(0))).first()
    assert tuple(empty) == (0,) * 7 + (None,)


def test_split_summary_joins_no_names(spark, sf_dir):
    """Of the joins only the one of the two rows of counts is left."""
    found = queries.split_summary(spark, sf_dir)
    assert "LeftOuter" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.select(F.col("train") + F.col("val") + F.col("test")).first()[0] > 0
