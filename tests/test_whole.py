"""Registered queries and operators on all of their rows, against brute force."""

from __future__ import annotations

import pytest

from skyloom.operators import georeference, testset
from skyloom.plans.queries import QUERIES
from skyloom.plans.views import view


def test_slanted_overlap_has_all_footprints(spark, sf_dir):
    boxes = [(r.image_name, r.x0, r.y0, r.x0 + r.fw + 1.0, r.y0 + r.fh) for r in view(spark, sf_dir, "footprints").collect()]
    expected = {(a[0], b[0]) for a in boxes for b in boxes if a[0] < b[0] and a[1] < b[3] and b[1] < a[3] and a[2] < b[4] and b[2] < a[4]}
    assert any("IMG_1009" in pair for pair in expected)
    assert {(r.l_image_name, r.r_image_name) for r in QUERIES["slanted_overlap"](spark, sf_dir).collect()} == expected


def test_mesh_hits_of_level_and_upward_rays(spark):
    point = "struct<x:double,y:double,z:double>"
    wall = [(1, (30.0, -50.0, 0.0), (30.0, 50.0, 0.0), (30.0, 0.0, 40.0)), (2, (0.0, -50.0, 60.0), (100.0, -50.0, 60.0), (0.0, 80.0, 60.0))]
    triangles = spark.createDataFrame(wall, f"face_id long, a {point}, b {point}, c {point}")
    rays = [
        (0, -5.0, 1.0, 10.0, 1.0, 0.0, 0.0),  # level, to the wall
        (1, -5.0, 1.0, 10.0, 1.0, 0.0, -1e-8),  # almost level
        (2, 20.0, 1.0, 10.0, 0.0, 0.0, 1.0),  # up, to the ceiling
        (3, 20.0, 1.0, 10.0, -1.0, 0.0, 0.0),  # level, away
        (4, 20.0, 1.0, 70.0, 1.0, 0.0, 0.0),  # level, above the mesh
        (5, 20.0, 1.0, 70.0, 0.0, 0.0, 1.0),  # up, above the mesh
    ]
    frame = spark.createDataFrame(rays, "k int, ox double, oy double, oz double, dx double, dy double, dz double")
    found = {r.k: (r.face_id, r.t) for r in georeference.mesh_hits(frame, triangles, ["k"], 6.0).collect()}
    assert found == {0: (1, pytest.approx(35.0)), 1: (1, pytest.approx(35.0)), 2: (2, pytest.approx(50.0))}


def test_test_sets_compare_rings_not_bounds(spark):
    def rows(*found):
        diamonds = [(n, [(x, y - 5.0), (x + 5.0, y), (x, y + 5.0), (x - 5.0, y)], x, y, x - 5.0, y - 5.0, x + 5.0, y + 5.0) for n, x, y in found]
        return spark.createDataFrame(diamonds, "image_name string, ring array<struct<x:double,y:double>>, centroid_x double, centroid_y double, x0 double, y0 double, x1 double, y1 double")

    # "apart" shares its bounds alone with the diamond at the origin, "meets" its ring
    pool, other, far = rows(("apart", 8.0, 8.0), ("meets", -4.0, -4.0), ("away", 90.0, 0.0)), rows(("origin", 0.0, 0.0)), rows(("far", 900.0, 0.0))
    hull = spark.createDataFrame([([],)], "hull array<struct<x:double,y:double>>")
    assert {r.image_name for r in testset.isolated(pool, other, far).collect()} == {"apart", "away"}
    assert {r.image_name for r in testset.isolated(pool, far, other).collect()} == {"apart", "away"}
    assert {r.image_name for r in testset.candidates(pool, other, hull).collect()} == {"meets"}
