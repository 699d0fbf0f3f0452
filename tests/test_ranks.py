"""Ranks write what is read later, and look an offset up without a search."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyloom.operators import spatial
from skyloom.plans import queries


@pytest.fixture
def written(monkeypatch):
    """The columns of the tables that ranks write."""
    found, write = [], spatial.materialize

    def noted(df):
        if "__id" in df.columns:
            found.append(set(df.columns) - {"__id"})
        return write(df)

    monkeypatch.setattr(spatial, "materialize", noted)
    return found


def test_split_by_campaign_sorts_only_columns_that_are_read(spark, sf_dir, written):
    assert queries.split_by_campaign(spark, sf_dir).agg(F.sum("n")).first()[0] > 0
    assert written == [{"image_name", "campaign", "centroid_y", "area_m2", *spatial.BOUNDS}]


def test_offsets_of_ranges_are_not_searched(spark):
    """Partitions without rows, between others with some: ranks go on from 1, by position and not by a map's keys."""
    rows = spark.range(3000).select(F.when(F.col("id") < 2900, 7).otherwise(F.col("id")).alias("v"), F.col("id").alias("k"))
    found = spatial.ranked(rows, F.col("v"))
    assert sorted(r["rank"] for r in found.collect()) == list(range(1, 3001))
    assert [r.v for r in found.orderBy("rank").collect()] == [7] * 2900 + list(range(2900, 3000))
    assert "map(" not in found._jdf.queryExecution().analyzed().toString()
