"""Test sets that touch neither training tiles nor the southern buffer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions import ring
from skyloom.functions.text import share
from skyloom.operators.spatial import BOUNDS, touching
from skyloom.session import materialize

CELL = 8.0


def hull_of(points: np.ndarray) -> np.ndarray:
    """The convex hull of points (n, 2), counter-clockwise (monotone chain)."""
    ordered = np.unique(points[~np.isnan(points).any(1)], axis=0)
    if len(ordered) < 3:
        return ordered

    def chain(rows: np.ndarray) -> list[np.ndarray]:
        kept: list[np.ndarray] = []
        for p in rows:
            while len(kept) > 1:
                a, b = kept[-2], kept[-1]
                if (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) > 0:
                    break
                kept.pop()
            kept.append(p)
        return kept[:-1]

    return np.array(chain(ordered) + chain(ordered[::-1]))


def outside(hull: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The points (n, 2) that are not clearly inside a counter-clockwise hull: those within rounding of a side stay."""
    if len(hull) < 3:
        return points
    clear = 64 * np.finfo(float).eps * max(np.abs(hull).max(), 1.0) ** 2
    inside = np.ones(len(points), bool)
    for a, b in zip(hull, np.roll(hull, -1, 0), strict=True):
        inside &= (b[0] - a[0]) * (points[:, 1] - a[1]) - (b[1] - a[1]) * (points[:, 0] - a[0]) > clear
    return points[~inside]


def grown(hull: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The hull of a hull and further points, of which only those that it does not hold are sorted."""
    beyond = outside(hull, points)
    return hull_of(np.concatenate([hull, beyond])) if len(beyond) else hull


def convex_hull(points: DataFrame) -> DataFrame:
    """One row: the hull of points(x, y) as a counter-clockwise ring.

    Each task sends the hull of its own points; the hull of those few points is
    the hull of all.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((0, 2))
        for batch in batches:
            xy = np.stack([batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)], 1).astype(float)
            kept = grown(kept, xy)
        yield pa.RecordBatch.from_pydict({"x": kept[:, 0], "y": kept[:, 1]}) if len(kept) else pa.RecordBatch.from_pydict({"x": np.zeros(0), "y": np.zeros(0)})

    @F.arrow_udf("array<struct<x:double,y:double>>")
    def whole(rings: pa.Array) -> pa.Array:
        out = []
        for corners in rings.to_pylist():
            xy = np.array([(c["x"], c["y"]) for c in corners or []]).reshape(-1, 2)
            out.append([{"x": x, "y": y} for x, y in hull_of(xy).tolist()])
        return pa.array(out, pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))

    parts = points.select(F.col("x").cast("double"), F.col("y").cast("double")).mapInArrow(partial, "x double, y double")
    return parts.agg(F.collect_list(F.struct("x", "y")).alias("corners")).select(whole("corners").alias("hull"))


def candidates(unlabelled: DataFrame, test: DataFrame, hull: DataFrame, key: str = "image_name", cell: float = CELL) -> DataFrame:
    """Unlabelled footprints with their centroid inside the hull of the test set, or that touch a test footprint.

    The hull is one row and is broadcast with its sides and bounds; its sides are
    looked at for rows within its bounds alone. Touching goes by cells.
    """
    near = _meeting(unlabelled, test, key, cell).withColumn("__near", F.lit(True))
    whole = hull.select(ring.sides(F.col("hull")).alias("__sides"), ring.bounds(F.col("hull")).alias("__bounds"))
    flagged = unlabelled.join(near, key, "left").crossJoin(F.broadcast(whole))
    x, y = F.col("centroid_x"), F.col("centroid_y")
    within = (x > F.col("__bounds.x0")) & (x < F.col("__bounds.x1")) & (y > F.col("__bounds.y0")) & (y < F.col("__bounds.y1"))
    inside = (F.size("__sides") > 2) & within & ring.left_of_all(F.col("__sides"), ring.point(x, y))
    return flagged.where(F.col("__near") | inside).drop("__near", "__sides", "__bounds")


def combined(test: DataFrame, unlabelled: DataFrame) -> DataFrame:
    """Both cohorts with their slice_type; a name in both stays twice."""
    return test.withColumn("slice_type", F.lit("labeled_test")).unionByName(unlabelled.withColumn("slice_type", F.lit("unlabeled_test")), allowMissingColumns=True)


def south_buffer(dropped: DataFrame, limit: float = 5_332_400.0) -> DataFrame:
    """Dropped footprints south of a northing."""
    return dropped.where(F.col("centroid_y") < limit)


def isolated(pool: DataFrame, train: DataFrame, buffer: DataFrame, key: str = "image_name", cell: float = CELL) -> DataFrame:
    """Rows of pool whose name touches neither a training footprint nor the buffer (closed).

    Both are tried as one table where pool meets them by the same columns. Pool is
    written once, as a semi-join reads its rows several times.
    """
    pool = materialize(pool)
    sides = [[*BOUNDS, *(["ring"] if "ring" in pool.columns and "ring" in df.columns else [])] for df in (train, buffer)]
    others = [df.select(*columns) for df, columns in zip((train, buffer), sides, strict=True)]
    for other in [others[0].unionByName(others[1])] if sides[0] == sides[1] else others:
        pool = pool.join(_meeting(pool, other, key, cell), key, "left_anti")
    return pool


def _meeting(left: DataFrame, right: DataFrame, key: str, size: float) -> DataFrame:
    """Keys of left rows that meet a row of right: by rings where both have them, else by bounds."""
    return (exact_touching if "ring" in left.columns and "ring" in right.columns else touching)(left, right, key, size)


def exact_touching(left: DataFrame, right: DataFrame, key: str, size: float) -> DataFrame:
    """touching() for rings of any shape: bounds first, then borders and insides."""
    return touching(left, right, key, size, columns=("ring",), where=ring.intersects(F.col("l_ring"), F.col("r_ring")))


def metrics(rows: DataFrame) -> DataFrame:
    """One row of counts over rows(slice_type, n_boxes): labelled foreground and background, unlabelled rows as background, boxes, percents."""
    labelled, boxes = F.col("slice_type") == "labeled_test", F.coalesce("n_boxes", F.lit(0))
    counts = rows.agg(
        F.count("*").alias("total"),
        F.count_if(labelled & (boxes > 0)).alias("fg"),
        F.count_if(~labelled | (boxes == 0)).alias("bg"),
        F.sum(F.when(labelled, boxes).otherwise(0)).cast("long").alias("boxes"),
    )
    return counts.withColumns({"fg_pct": F.round(share(F.col("fg"), F.col("total")), 6), "bg_pct": F.round(share(F.col("bg"), F.col("total")), 6)})


def with_source(pure: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """pure with source: copy where the file is present, crop where it has to be cut anew."""
    there = present.select(key).distinct().withColumn("__there", F.lit(True))
    return pure.join(there, key, "left").withColumn("source", F.when(F.col("__there"), "copy").otherwise("crop")).drop("__there")


def crops(needed: DataFrame, tiles: DataFrame, photos: DataFrame) -> DataFrame:
    """Crops by parent photo: one row a photo with its ordered crops, so that it is decoded once.

    needed(tile) without tile metadata, or without a photo, is left out and can be
    found by an anti join.
    """
    located = needed.join(tiles, "tile").join(photos, "parent_image")
    return located.groupBy("parent_image", "path").agg(F.array_sort(F.collect_list(F.struct("y_start", "x_start", "y_end", "x_end", "tile"))).alias("crops"))


def first_extension(files: DataFrame, order: tuple[str, ...] = (".jpg", ".png", ".jpeg")) -> DataFrame:
    """For each stem the file whose suffix comes first in order."""
    place: Column = F.array_position(F.array(*map(F.lit, order)), F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)))
    return files.where(place > 0).groupBy("stem").agg(F.min_by("path", F.struct(place, F.col("path"))).alias("path"))
