"""Rings, projections, rays, hulls and grid joins against values worked out by hand or brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import faces, projection, ring
from skyloom.functions.text import match_key, stem
from skyloom.operators import analytics, georeference, slicing, spatial, stratify, testset

RING = "array<struct<x:double,y:double>>"


def _one(spark, *rings):
    names = "abc"[: len(rings)]
    return spark.createDataFrame([tuple(rings)], ", ".join(f"{n} {RING}" for n in names))


SQUARE = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
DIAMOND = [(1.0, -1.0), (3.0, 1.0), (1.0, 3.0), (-1.0, 1.0)]


def test_area_and_centroid(spark):
    row = _one(spark, SQUARE[::-1], [(0.0, 0.0), (4.0, 0.0), (0.0, 3.0)]).select(ring.area(F.col("a")).alias("s"), ring.signed_area(F.col("a")).alias("signed"), ring.area(F.col("b")).alias("t"), ring.centroid(F.col("b")).alias("c")).first()
    assert (row.s, row.signed, row.t, row.c.x, row.c.y) == (4.0, -4.0, 6.0, pytest.approx(4 / 3), pytest.approx(1.0))


@pytest.mark.parametrize(
    ("other", "area", "meets"),
    [
        (SQUARE, 4.0, True),
        (DIAMOND, 4.0, True),
        ([(1.0, 0.0), (3.0, 0.0), (3.0, 2.0), (1.0, 2.0)], 2.0, True),
        ([(2.0, 0.0), (3.0, 0.0), (3.0, 2.0), (2.0, 2.0)], 0.0, True),
        ([(2.5, 0.0), (3.0, 0.0), (3.0, 2.0), (2.5, 2.0)], 0.0, False),
        ([(0.0, 0.0), (2.0, 2.0), (0.0, 1.0), (-1.0, 3.0)], 1.0, True),
    ],
)
def test_overlap(spark, other, area, meets):
    row = _one(spark, SQUARE, other).select(ring.overlap_area(F.col("a"), F.col("b")).alias("v"), ring.overlap_area(F.col("b"), F.col("a")).alias("w"), ring.intersects(F.col("a"), F.col("b")).alias("m")).first()
    assert (row.v, row.w) == (pytest.approx(area), pytest.approx(area))
    assert row.m == meets


def test_bowtie(spark):
    tie = [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0)]
    found = faces.repaired(faces.repaired(_one(spark, tie, SQUARE), "a", "t"), "b", "n")
    row = found.select("t", "n", ring.area(F.col("a")).alias("area"), F.col("b").alias("same")).first()
    assert (row.t, row.n, row.area) == (True, False, pytest.approx(1.0))
    assert [tuple(p) for p in row.same] == SQUARE


def _wound_area(corners):
    """Area of what a ring winds around in its own sense, by slabs between all corners and crossings."""
    sides = list(zip(corners, corners[1:] + corners[:1], strict=True))
    sense = 1 if sum(p[0] * q[1] - q[0] * p[1] for p, q in sides) >= 0 else -1
    xs = {p[0] for p in corners}
    for i, (p, q) in enumerate(sides):
        for r, s in sides[:i]:
            down = (q[0] - p[0]) * (s[1] - r[1]) - (q[1] - p[1]) * (s[0] - r[0])
            if down:
                t = ((r[0] - p[0]) * (s[1] - r[1]) - (r[1] - p[1]) * (s[0] - r[0])) / down
                if 0 <= t <= 1:
                    xs.add(p[0] + t * (q[0] - p[0]))
    total, ordered = 0.0, sorted(xs)
    for x0, x1 in zip(ordered, ordered[1:], strict=False):
        x = (x0 + x1) / 2
        at = sorted((p[1] + (x - p[0]) / (q[0] - p[0]) * (q[1] - p[1]), 1 if q[0] > p[0] else -1) for p, q in sides if min(p[0], q[0]) < x < max(p[0], q[0]))
        wound = 0
        for (y, step), (above, _) in zip(at, at[1:], strict=False):
            wound += step
            total += (above - y) * (x1 - x0) * (wound * sense > 0)
    return total


@pytest.mark.parametrize("grid", [None, 6])
def test_repair_of_any_ring(spark, grid):
    """Rings of 5 to 12 corners that cross themselves anyhow; on a coarse grid corners also lie on sides and on each other."""
    rng = random.Random(2)
    number = (lambda: float(rng.randrange(grid))) if grid else (lambda: rng.uniform(0, 100))
    rings = [[(number(), number()) for _ in range(rng.randrange(5, 13))] for _ in range(300)]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rings)], f"i int, fixed {RING}")
    fixed = faces.repaired(frame, "fixed", "broken")
    rows = fixed.select("i", "broken", "fixed", ring.area(F.col("fixed")).alias("area"), F.size(ring.border(F.col("fixed"))).alias("sides")).collect()
    assert sum(r.broken for r in rows) > 200
    for r in rows:
        assert r.area == pytest.approx(_wound_area(rings[r.i]), abs=1e-6), rings[r.i]
        assert r.sides <= len(r.fixed)


def test_repair_joins_faces_by_bridges(spark):
    """Two lobes of one sense with one of the other between them: both count, the bridge touches nothing."""
    chain = [(0.0, 0.0), (4.0, 3.0), (8.0, 0.0), (12.0, 3.0), (12.0, 0.0), (8.0, 3.0), (4.0, 0.0), (0.0, 3.0)]
    near = [(5.9, 1.4), (6.1, 1.4), (6.1, 1.6), (5.9, 1.6)]
    fixed = faces.repaired(_one(spark, chain, near), "a").withColumnRenamed("a", "f")
    row = fixed.select(ring.area(F.col("f")).alias("area"), ring.intersects(F.col("f"), F.col("b")).alias("meets"), ring.overlap_area(F.col("f"), F.col("b")).alias("common")).first()
    assert row.area == pytest.approx(_wound_area(chain))
    assert row.meets == (row.common > 0)


def _simple_ring(rng, size):
    """A star-shaped ring of grid points around one of them, mostly concave."""
    import math

    cx, cy = rng.randrange(30), rng.randrange(30)
    points = {(cx + rng.randrange(-size, size + 1), cy + rng.randrange(-size, size + 1)) for _ in range(9)} - {(cx, cy)}
    by_angle = {}
    for p in points:
        by_angle.setdefault(round(math.atan2(p[1] - cy, p[0] - cx), 9), p)
    ring_ = [(float(x), float(y)) for _, (x, y) in sorted(by_angle.items())]
    angles = sorted(by_angle)
    wide = any(b - a >= math.pi - 1e-6 for a, b in zip(angles, [*angles[1:], angles[0] + 2 * math.pi], strict=True))
    return None if len(ring_) < 3 or wide else ring_


def _brute_meet(one, other):
    turn = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    on = lambda a, b, p: turn(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])
    sides = lambda r: list(zip(r, r[1:] + r[:1], strict=True))
    for a, b in sides(one):
        for c, d in sides(other):
            if on(a, b, c) or on(a, b, d) or on(c, d, a) or on(c, d, b) or (turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0):
                return True

    def inside(r, p):
        return sum((a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in sides(r)) % 2 == 1

    return inside(one, other[0]) or inside(other, one[0])


def test_contacts_of_any_ring(spark):
    """Concave rings, one inside another, side by side and in each other's notches."""
    rng = random.Random(8)
    rings = [r for r in (_simple_ring(rng, rng.choice([3, 6, 14])) for _ in range(130)) if r]
    rings += [[(0.0, 0.0), (10.0, 0.0), (2.0, 2.0), (0.0, 10.0)], [(0.5, 0.5), (1.0, 0.5), (1.0, 1.0), (0.5, 1.0)], [(6.0, 6.0), (7.0, 6.0), (7.0, 7.0), (6.0, 7.0)], [(2.0, 2.0), (9.0, 9.0), (9.0, 10.0), (8.0, 10.0)]]
    frame = spark.createDataFrame(list(enumerate(rings)), f"i int, r {RING}")
    pairs = frame.alias("a").join(frame.alias("b"), F.col("a.i") < F.col("b.i"))
    rows = pairs.select(F.col("a.i").alias("i"), F.col("b.i").alias("j"), ring.intersects(F.col("a.r"), F.col("b.r")).alias("m"), ring.overlap_area(F.col("a.r"), F.col("b.r")).alias("common")).collect()
    assert len(rows) > 3000 and 100 < sum(r.m for r in rows) < len(rows) - 100
    for r in rows:
        assert r.m == _brute_meet(rings[r.i], rings[r.j]), (rings[r.i], rings[r.j])
        assert r.m or r.common == pytest.approx(0, abs=1e-9)


def test_isolated_tiles_of_concave_footprints(spark):
    """A tile inside an arrowhead leaks, one in its notch does not."""
    rows = [("in", [(0.5, 0.5), (1.0, 0.5), (1.0, 1.0), (0.5, 1.0)]), ("notch", [(5.0, 5.0), (6.0, 5.0), (6.0, 6.0), (5.0, 6.0)])]
    pool = stratify.with_measures(spark.createDataFrame(rows, f"image_name string, ring {RING}"))
    train = stratify.with_measures(spark.createDataFrame([("t", [(0.0, 0.0), (10.0, 0.0), (2.0, 2.0), (0.0, 10.0)])], f"image_name string, ring {RING}"))
    assert [r.image_name for r in testset.isolated(pool, train, train.limit(0)).collect()] == ["notch"]


def test_utm(spark):
    rng = random.Random(2)
    places = [(16.79, 48.13), (15.0, 0.0), (12.1, -70.0), *((rng.uniform(12, 18), rng.uniform(-80, 84)) for _ in range(200))]
    rows = spark.createDataFrame(places, "lon double, lat double")
    there = projection.with_utm(rows, F.col("lon"), F.col("lat"))
    back = projection.with_lon_lat(there, F.col("easting"), F.col("northing"), ("lon2", "lat2")).collect()
    assert max(max(abs(r.lon - r.lon2), abs(r.lat - r.lat2)) for r in back) < 1e-9
    found = {r.lon: r for r in back}
    assert (found[16.79].easting, found[16.79].northing) == (pytest.approx(633187.8, abs=0.1), pytest.approx(5332298.8, abs=0.1))
    assert (found[15.0].easting, found[15.0].northing) == (pytest.approx(500000.0), pytest.approx(0.0, abs=1e-6))
    with pytest.raises(ValueError, match="UTM"):
        projection.zone_of(3857)


def test_ecef(spark):
    lat, lon, height = np.radians(48.0), np.radians(16.0), 250.0
    n = projection.A / np.sqrt(1 - projection.E2 * np.sin(lat) ** 2)
    xyz = [((n + height) * np.cos(lat) * np.cos(lon), (n + height) * np.cos(lat) * np.sin(lon), (n * (1 - projection.E2) + height) * np.sin(lat))]
    row = projection.with_geodetic(spark.createDataFrame([tuple(map(float, xyz[0]))], "x double, y double, z double"), F.col("x"), F.col("y"), F.col("z")).first()
    assert (row.lon, row.lat, row.height) == (pytest.approx(16.0, abs=1e-10), pytest.approx(48.0, abs=1e-10), pytest.approx(250.0, abs=1e-4))


def test_hull(spark):
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(size=(500, 2)), [[9.0, 0.0], [0.0, 9.0], [-9.0, 0.0], [0.0, -9.0], [0.0, -9.0]]])
    rows = spark.createDataFrame([tuple(map(float, p)) for p in points], "x double, y double").repartition(7)
    hull = np.array([tuple(p) for p in testset.convex_hull(rows).first().hull])
    assert {tuple(p) for p in hull.tolist()} == {(9.0, 0.0), (0.0, 9.0), (-9.0, 0.0), (0.0, -9.0)}
    assert testset.convex_hull(rows.limit(0)).first().hull == []


def test_grid_join_is_the_nested_loop(spark):
    rng = random.Random(6)
    boxes = [(i, x := rng.randint(-40, 40) / 2, y := rng.randint(-40, 40) / 2, x + rng.randint(1, 20) / 2, y + rng.randint(1, 20) / 2) for i in range(150)]
    rows = spark.createDataFrame(boxes, "k int, x0 double, y0 double, x1 double, y1 double")
    for closed in (True, False):
        found = sorted((r.l_k, r.r_k) for r in spatial.box_pairs(rows, rows, 4.0, closed).collect())
        less = (lambda a, b: a <= b) if closed else (lambda a, b: a < b)
        expected = sorted((a[0], b[0]) for a in boxes for b in boxes if less(a[1], b[3]) and less(b[1], a[3]) and less(a[2], b[4]) and less(b[2], a[4]))
        assert found == expected


def test_rank(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("v"))
    found = spatial.ranked(rows, F.col("v")).collect()
    order = sorted(r.v for r in found)
    assert all(order[r["rank"] - 1] == r.v for r in found)
    assert spatial.ranked(rows.limit(0), F.col("v")).count() == 0


@pytest.mark.parametrize("length", [1024, 1025, 1843, 2662, 8192])
def test_origins_are_pythons_range(spark, length):
    row = spark.range(1).select(slicing.origins(F.lit(length), 1024, 819).alias("o")).first()
    assert row.o == sorted({*range(0, length - 1024, 819), length - 1024})


def test_no_leaks_remain(spark):
    rng = random.Random(8)
    quads = [(f"n{i}", [(x := rng.uniform(0, 60), y := rng.uniform(0, 60)), (x + 4, y + 1), (x + 5, y + 5), (x + 1, y + 4)]) for i in range(120)]
    prints = stratify.with_measures(spark.createDataFrame(quads, f"image_name string, ring {RING}"))
    allocated = stratify.spatial_split(stratify.drop_oversized(prints))
    kept = stratify.allocation(allocated, cell=8.0)
    assert stratify.cross_split_pairs(kept, cell=8.0).where("overlap_pct > 0").count() == 0
    sizes = {r.split: r["count"] for r in kept.groupBy("split").count().collect()}
    assert sizes["test"] == sizes["val"] == int(120 * 0.07)


def test_ray_from_camera_to_footprint(spark):
    identity = [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    tile = spark.createDataFrame([("t", 0, 0, 1024, 1024)], "tile string, x_start int, y_start int, x_end int, y_end int")
    corners = georeference.corners(tile)
    assert [(r.px, r.py) for r in corners.orderBy("corner_ord").collect()] == [(0, 0), (1024, 0), (1024, 1024), (0, 1024)]
    # a camera above (48 N, 15 E) whose axis points to the earth's centre
    lat = np.radians(48.0)
    lon = np.radians(15.0)
    up = np.array([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)])
    east = np.array([-np.sin(lon), np.cos(lon), 0.0])
    place = up * 6_367_000.0
    pose = np.eye(4)
    pose[:3, 0], pose[:3, 1], pose[:3, 2], pose[:3, 3] = east, -np.cross(up, east), -up, place
    points = corners.withColumns({"w": F.lit(1024.0), "h": F.lit(1024.0), "f": F.lit(1024.0), "cx": F.lit(0.0), "cy": F.lit(0.0), "transform": F.array(*map(F.lit, pose.ravel().tolist())), "component": F.array(*map(F.lit, identity))})
    rays = georeference.rays(points)
    ground = rays.withColumn("hit", georeference.plane_hit(F.col("oz") - 100.0)).select("tile", F.lit("2023").alias("campaign"), F.lit(1).alias("campaign_ord"), "corner_ord", "hit.x", "hit.y", "hit.z", F.lit(True).alias("fallback"))
    found = georeference.footprints(ground).first()
    assert found.status == "Mixed/Fallback" and len(found.corners) == 4
    assert found.corners[0].lon < 15 < found.corners[1].lon and found.corners[0].lat > found.corners[2].lat
    wide = georeference.wide_corners(georeference.footprints(ground))
    assert len(wide.columns) == 14


def test_mesh_hits_are_the_nearest(spark):
    rng = np.random.default_rng(9)
    faces = [(i, *[tuple(map(float, p)) for p in rng.uniform(0, 40, 3) + rng.uniform(-4, 4, (3, 3))]) for i in range(200)]
    point = "struct<x:double,y:double,z:double>"
    triangles = spark.createDataFrame(faces, f"face_id long, a {point}, b {point}, c {point}")
    direction = rng.normal(size=(60, 3)) * [1, 1, 0.5] - [0, 0, 1.5]
    direction /= np.linalg.norm(direction, axis=1)[:, None]
    rays = [(i, *map(float, rng.uniform(0, 40, 2)), 60.0, *map(float, d)) for i, d in enumerate(direction)]
    frame = spark.createDataFrame(rays, "k int, ox double, oy double, oz double, dx double, dy double, dz double")
    found = {r.k: r for r in georeference.mesh_hits(frame, triangles, ["k"], 6.0).collect()}
    finer = {r.k: r for r in georeference.mesh_hits(frame, triangles, ["k"], 1.3, 1).collect()}
    assert {k: (r.face_id, r.t) for k, r in finer.items()} == {k: (r.face_id, r.t) for k, r in found.items()}
    corners = np.array([f[1:] for f in faces])
    for k, *rest in rays:
        o, d = np.array(rest[:3]), np.array(rest[3:])
        e1, e2 = corners[:, 1] - corners[:, 0], corners[:, 2] - corners[:, 0]
        p = np.cross(d, e2)
        det = (e1 * p).sum(1)
        s = o - corners[:, 0]
        q = np.cross(s, e1)
        u, v, t = (s * p).sum(1) / det, (q * d).sum(1) / det, (e2 * q).sum(1) / det
        hits = t[(u >= 0) & (v >= 0) & (u + v <= 1) & (t > 0)]
        assert (k in found) == bool(len(hits))
        if len(hits):
            assert found[k].t == pytest.approx(hits.min())


def test_rays_front_to_back(spark, monkeypatch):
    """Rays along the sides of cubes, rays of many rounds, and floors that the one on top hides: they make no pairs."""
    point = "struct<x:double,y:double,z:double>"
    floors = [(100 * z + 10 * x + y, (4.0 * x, 4.0 * y, 4.0 * z), (4.0 * x + 8, 4.0 * y, 4.0 * z), (4.0 * x, 4.0 * y + 8, 4.0 * z)) for x in range(8) for y in range(8) for z in range(10)]
    triangles = spark.createDataFrame([*floors, (-1, (32.0, 0.0, 0.0), (32.0, 32.0, 0.0), (32.0, 0.0, 90.0))], f"face_id long, a {point}, b {point}, c {point}")
    rays = [(i, 1.0 + i % 7 * 4, 1.0 + i // 7 * 4, 80.0, 0.0, 0.0, -1.0) for i in range(49)]
    rays += [
        (100, 8.0, 8.0, 80.0, 0.0, 0.0, -1.0),  # down an edge of the cubes
        (101, -60.0, 1.0, 38.0, 1.0, 0.0, 0.0),  # level above the floors, to the wall at the far end
        (102, -60.0, 4.0, 36.0 + 1e-9, 1.0, 0.0, 0.0),  # along a side of the cubes
        (103, 10.0, 10.0, 100.0, 0.0, 0.0, 1.0),  # away
    ]
    seen = []
    plain = georeference._with_distance
    monkeypatch.setattr(georeference, "_with_distance", lambda pairs: (seen.append(pairs.where("face_id is not null").count()), plain(pairs))[1])
    frame = spark.createDataFrame(rays, "k int, ox double, oy double, oz double, dx double, dy double, dz double")
    found = {r.k: (r.face_id, round(r.t, 6), round(r.z, 6)) for r in georeference.mesh_hits(frame, triangles, ["k"], 4.0).collect()}
    assert all(found[i][1:] == (44.0, 36.0) for i in range(49)) and found[100][1:] == (44.0, 36.0)
    assert found[101] == (-1, 92.0, 38.0) and found[102][:2] == (-1, 92.0) and 103 not in found
    assert len(seen) == 2 or len(seen) == 3
    in_rounds = sum(seen)
    seen.clear()
    whole = {r.k: (r.face_id, round(r.t, 6), round(r.z, 6)) for r in georeference.mesh_hits(frame, triangles, ["k"], 4.0, 1000).collect()}
    assert {k: v[1:] for k, v in whole.items()} == {k: v[1:] for k, v in found.items()}
    # the second round of 12 cubes reaches the upper half of the floors, and nobody goes on to the lower one
    assert len(seen) == 1 and in_rounds < 0.6 * seen[0]


def test_histogram_closes_its_last_bin(spark):
    rows = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    assert {r.bin: r.n for r in analytics.histogram(rows, F.col("v"), 5).collect()} == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}
    assert [tuple(r) for r in analytics.histogram(rows.where("v = 3"), F.col("v"), 5).collect()] == [(1, 1)]
    total = analytics.density(rows, "v").agg(F.sum("density") * 10 / 199).first()[0]
    assert 0.7 < total < 1.0


def test_names(spark):
    rows = spark.createDataFrame([("a.b.jpg",), (" IMG_1.JPG\t",), (".hidden",), ("noext",), ("d/x.png",)], "n string")
    assert [r.s for r in rows.select(stem(F.col("n")).alias("s")).collect()] == ["a.b", "IMG_1", ".hidden", "noext", "x"]
    assert rows.select(match_key(F.col("n")).alias("k")).collect()[1].k == "img_1"
