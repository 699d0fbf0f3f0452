"""Photos to tiles, and their boxes to tile labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.text import chance

TILE = 1024
OVERLAP = 0.2
MIN_AREA = 0.2
MIN_SIDE = 0.005
BACKGROUND = {"train": 0.10, "val": 1.0, "test": 1.0}


def stride_of(tile: int = TILE, overlap: float = OVERLAP) -> int:
    stride = int(tile * (1.0 - overlap))
    if stride < 1:
        raise ValueError(f"an overlap of {overlap} leaves no stride")
    return stride


def origins(length: Column, tile: int, stride: int) -> Column:
    """Ascending tile origins along an axis; the last tile ends flush with the edge."""
    last = length - tile
    inner = F.when(last > 0, F.sequence(F.lit(0), last - 1, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.concat(inner, F.array(last)))


def tile_grid(photos: DataFrame, tile: int = TILE, overlap: float = OVERLAP) -> DataFrame:
    """photos(parent_image, w, h, split) to tiles; photos smaller than a tile give none."""
    stride = stride_of(tile, overlap)
    large = photos.where((F.col("w") >= tile) & (F.col("h") >= tile))
    rows = large.withColumn("y_start", F.explode(origins(F.col("h"), tile, stride)))
    cells = rows.withColumn("x_start", F.explode(origins(F.col("w"), tile, stride)))
    return cells.select(
        F.concat_ws("_", "parent_image", "x_start", "y_start").alias("tile"),
        "parent_image",
        F.col("split").alias("split_source"),
        "x_start",
        "y_start",
        (F.col("x_start") + tile).alias("x_end"),
        (F.col("y_start") + tile).alias("y_end"),
    )


def tile_labels(photos: DataFrame, boxes: DataFrame, tile: int = TILE, overlap: float = OVERLAP, min_area: float = MIN_AREA, keep: tuple[str, ...] = ()) -> DataFrame:
    """Boxes clipped to the tiles they reach into.

    boxes(parent_image, class_id, xc, yc, bw, bh, *keep) meet their photo first and
    find their tiles by arithmetic, so the join is on the parent alone: no box is
    compared with a tile it does not touch, and a photo with many boxes needs no
    wider task than one row each.
    """
    stride = stride_of(tile, overlap)
    size = photos.where((F.col("w") >= tile) & (F.col("h") >= tile)).select("parent_image", F.col("split").alias("split_source"), F.col("w").cast("double").alias("w"), F.col("h").cast("double").alias("h"))
    pixels = boxes.join(size, "parent_image").select(
        "parent_image", "split_source", "class_id", *keep, "w", "h",
        (F.col("xc") * F.col("w")).alias("cx"), (F.col("yc") * F.col("h")).alias("cy"),
        (F.col("bw") * F.col("w")).alias("pw"), (F.col("bh") * F.col("h")).alias("ph"),
    )
    corners = pixels.withColumns({"bx0": F.col("cx") - F.col("pw") / 2, "bx1": F.col("cx") + F.col("pw") / 2, "by0": F.col("cy") - F.col("ph") / 2, "by1": F.col("cy") + F.col("ph") / 2})
    rows = corners.withColumn("y_start", F.explode(_reached("by0", "by1", "h", tile, stride)))
    cells = rows.withColumn("x_start", F.explode(_reached("bx0", "bx1", "w", tile, stride)))
    x0, y0 = F.col("x_start").cast("double"), F.col("y_start").cast("double")
    local = cells.withColumns(
        {
            "lx0": F.greatest(F.col("bx0"), x0) - x0,
            "lx1": F.least(F.col("bx1"), x0 + tile) - x0,
            "ly0": F.greatest(F.col("by0"), y0) - y0,
            "ly1": F.least(F.col("by1"), y0 + tile) - y0,
        }
    ).withColumns({"lw": F.col("lx1") - F.col("lx0"), "lh": F.col("ly1") - F.col("ly0")})
    whole = F.col("pw") * F.col("ph")
    labels = local.select(
        F.concat_ws("_", "parent_image", "x_start", "y_start").alias("tile"),
        "split_source",
        "class_id",
        *keep,
        ((F.col("lx0") + F.col("lw") / 2) / tile).alias("xc"),
        ((F.col("ly0") + F.col("lh") / 2) / tile).alias("yc"),
        (F.col("lw") / tile).alias("bw"),
        (F.col("lh") / tile).alias("bh"),
        F.when(whole > 0, F.col("lw") * F.col("lh") / F.when(whole > 0, whole)).otherwise(F.lit(0.0)).alias("completeness"),
    )
    return labels.where((F.col("bw") > MIN_SIDE) & (F.col("bh") > MIN_SIDE) & (F.col("completeness") >= min_area))


def _reached(low: str, high: str, length: str, tile: int, stride: int) -> Column:
    """Origins of the tiles that an interval overlaps by more than an edge, whatever the photo's width.

    Tiles at multiples of the stride follow by division, with one more at each end
    for rounding; the tile flush with the edge stands apart.
    """
    last = F.col(length).cast("int") - tile
    inner = F.floor((last - 1) / stride)  # of the tiles before the flush one, the last; -1 if there is none
    first = F.greatest(F.floor((F.col(low) - tile) / stride), F.lit(0))
    end = F.least(F.floor(F.col(high) / stride) + 1, inner)
    near = F.when(first <= end, F.transform(F.sequence(first, end), lambda k: (k * stride).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.filter(F.concat(near, F.array(last)), lambda o: (F.col(low) < o + tile) & (F.col(high) > o))


def with_background(tiles: DataFrame, labelled: DataFrame, chances: dict[str, float] | None = None) -> DataFrame:
    """Tiles that are kept, with is_foreground: those with labels, and others by a hash of their name."""
    chances = BACKGROUND if chances is None else chances
    seen = labelled.select("tile").distinct().withColumn("is_foreground", F.lit(True))
    odds = F.when(F.col("split_source") == "val", chances["val"]).when(F.col("split_source") == "test", chances["test"]).otherwise(chances["train"])
    marked = tiles.join(seen, "tile", "left").withColumn("is_foreground", F.coalesce("is_foreground", F.lit(False)))
    return marked.where(F.col("is_foreground") | (chance(F.col("tile")) < odds))
