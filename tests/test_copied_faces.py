"""Faces that lie upon each other count as one."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.operators import georeference


def test_copies_of_faces_make_no_pairs(spark):
    """300 copies of two faces, in falling order of their ids: a ray meets each face once, and names its least id."""
    at = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(0.0).alias("z"))
    copies = spark.range(300).select((599 - 2 * F.col("id")).alias("n"))
    faces = copies.select(F.col("n").alias("face_id"), at(0.0, 0.0).alias("a"), at(9.0, 0.0).alias("b"), at(9.0, 9.0).alias("c")).union(
        copies.select((F.col("n") - 1).alias("face_id"), at(0.0, 0.0).alias("a"), at(9.0, 9.0).alias("b"), at(0.0, 9.0).alias("c"))
    )
    rays = spark.createDataFrame([(i, 4.0 + (i % 2) * 2, 5.0, 8.0, 0.0, 0.0, -1.0) for i in range(50)], "k int, ox double, oy double, oz double, dx double, dy double, dz double")
    found = georeference.mesh_hits(rays, faces.repartition(3), ["k"], 10.0).collect()
    assert {(r.k % 2, r.t, r.face_id) for r in found} == {(0, 8.0, 0), (1, 8.0, 1)}
    assert len(found) == 50
