"""Label, area and extent statistics, and the layers behind the maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.text import share
from skyloom.operators.spatial import touching

# COCO's limits of small and medium areas in square pixels.
SMALL, MEDIUM = 32 * 32, 96 * 96


def pixel_boxes(boxes: DataFrame, width: int = 1024, height: int = 1024) -> DataFrame:
    """Add w_px, h_px, area_px and drop boxes without an area."""
    sized = boxes.withColumns({"w_px": F.col("bw") * width, "h_px": F.col("bh") * height})
    return sized.where((F.col("w_px") > 0) & (F.col("h_px") > 0)).withColumn("area_px", F.col("w_px") * F.col("h_px"))


#: Values of which one task finds the median.
ONE_TASK = 2_000_000
#: Ranges that a round of medians() counts.
RANGES = 1_000


def medians(df: DataFrame, columns: list[str], one_task: int = ONE_TASK) -> dict[str, float | None]:
    """Exact medians of columns, nulls left out, of which no task holds all values.

    Each round counts the values in even ranges and goes on with the range that holds
    the middle rank, until that has one value or few enough to be looked at.
    """
    values = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns))).alias("r")).select("r.*").where("v is not null")
    whole = {r.c: (r.n, r.lo, r.hi) for r in values.groupBy("c").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    # (column, rank from 0) -> (range, ranks before it, values in it)
    open_ranks = {(c, k): (lo, hi, 0, n) for c, (n, lo, hi) in whole.items() for k in {(n - 1) // 2, n // 2}}
    found: dict[tuple[str, int], float] = {}
    while open_ranks:
        for key, (lo, hi, before, n) in list(open_ranks.items()):
            if lo == hi:
                found[key] = lo
                del open_ranks[key]
            elif n <= one_task:
                c, k = key
                inside = values.where((F.col("c") == c) & F.col("v").between(lo, hi))
                found[key] = inside.agg(F.array_sort(F.collect_list("v")).alias("v")).select(F.get("v", F.lit(k - before)).alias("x")).first().x
                del open_ranks[key]
        spans = {(c, lo, hi) for (c, _), (lo, hi, _, _) in open_ranks.items()}
        for c, lo, hi in spans:
            place = F.least(F.floor((F.col("v") - lo) / (hi - lo) * RANGES), F.lit(RANGES - 1))
            counts = values.where((F.col("c") == c) & F.col("v").between(lo, hi)).groupBy(place.alias("i")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            ordered = sorted(counts.collect(), key=lambda r: r.i)
            for key, (low, high, before, _) in list(open_ranks.items()):
                if (key[0], low, high) == (c, lo, hi):
                    for r in ordered:
                        if key[1] < before + r.n:
                            open_ranks[key] = (r.lo, r.hi, before, r.n)
                            break
                        before += r.n
    return {c: (found[c, (whole[c][0] - 1) // 2] + found[c, whole[c][0] // 2]) / 2 if c in whole else None for c in columns}


def area_summary(boxes: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """Count, mean and exact medians, and the sides' ranges."""
    columns = ["area_px", "w_px", "h_px"]
    few = boxes.limit(one_task + 1).count() <= one_task
    exact = {} if few else medians(boxes, columns, one_task)
    middle = {c: F.median(c) if few else F.lit(exact[c]).cast("double") for c in columns}
    return boxes.agg(
        F.count("*").alias("n"),
        F.avg("area_px").alias("mean_area"),
        middle["area_px"].alias("median_area"),
        *(v.alias(f"{name}_{c}") for c in ("w_px", "h_px") for name, v in (("min", F.min(c)), ("median", middle[c]), ("max", F.max(c)))),
        F.greatest(F.max("w_px"), F.max("h_px")).alias("max_side"),
    )


def size_classes(boxes: DataFrame) -> DataFrame:
    """Boxes and percent by COCO size."""
    name = F.when(F.col("area_px") < SMALL, "small").when(F.col("area_px") <= MEDIUM, "medium").otherwise("large")
    counts = boxes.groupBy(name.alias("size_class")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("size_class", "n", share(F.col("n"), F.col("total")).alias("pct"))


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """(bin from 1, n) of non-empty bins over the value's own range; the last bin is closed, a single value is all in bin 1."""
    values = df.select(value.alias("v")).where(F.col("v").isNotNull())
    limits = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    ranged = values.crossJoin(F.broadcast(limits))
    place = F.when(F.col("lo") == F.col("hi"), F.lit(1).cast("long")).otherwise(F.least(F.floor((F.col("v") - F.col("lo")) / F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")) * bins) + 1, F.lit(bins).cast("long")))
    return ranged.groupBy(place.alias("bin")).agg(F.count("*").alias("n"))


def area_log_histogram(boxes: DataFrame, bins: int = 50) -> DataFrame:
    """Bins even in log10 of the area."""
    return histogram(boxes, F.log10("area_px"), bins)


def heatmap(boxes: DataFrame, bins: int = 40) -> DataFrame:
    """(bin_x, bin_y, n) of box centres over their own range."""
    limits = boxes.agg(*(f(c).alias(f"{n}_{c}") for c in ("xc", "yc") for n, f in (("lo", F.min), ("hi", F.max))))
    ranged = boxes.select("xc", "yc").crossJoin(F.broadcast(limits))

    def place(c: str) -> Column:
        lo, hi = F.col(f"lo_{c}"), F.col(f"hi_{c}")
        return F.when(lo == hi, F.lit(1).cast("long")).otherwise(F.least(F.floor((F.col(c) - lo) / F.when(hi > lo, hi - lo) * bins) + 1, F.lit(bins).cast("long")))

    return ranged.groupBy(place("xc").alias("bin_x"), place("yc").alias("bin_y")).agg(F.count("*").alias("n"))


def density(df: DataFrame, value: str, points: int = 200, log: bool = False) -> DataFrame:
    """Gaussian kernel density on a grid of points (A17, A28), Scott's bandwidth.

    Values are first binned ten times finer than the grid, so the kernel sum is over
    a table of bounded size however many rows there are.
    """
    v = F.log10(value) if log else F.col(value).cast("double")
    stats = df.select(v.alias("v")).agg(F.count("v").alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    fine = 10 * points
    ranged = df.select(v.alias("v")).crossJoin(F.broadcast(stats)).where("v is not null and sd > 0")
    step = (F.col("hi") - F.col("lo")) / fine
    bins = ranged.groupBy("n", "sd", "lo", "hi", F.round((F.col("v") - F.col("lo")) / step).alias("b")).agg(F.count("*").alias("c"))
    h = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    grid = bins.withColumn("x", F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * i / (points - 1))))
    z = (F.col("x") - (F.col("lo") + F.col("b") * step)) / h
    return grid.groupBy("x").agg(F.sum(F.col("c") * F.exp(-z * z / 2) / (F.col("n") * h * 2.5066282746310002)).alias("density"))


def padded_extent(points: DataFrame, west: float, south: float, north: float, pad_x: float = 60.0, pad_bottom: float = 120.0, pad_top: float = 70.0) -> DataFrame:
    """One row: the bounds of points(x, y) and of fixed places, padded."""
    return points.agg(
        (F.least(F.min("x"), F.lit(west)) - pad_x).alias("x_min"),
        (F.greatest(F.max("x"), F.lit(west)) + pad_x).alias("x_max"),
        (F.least(F.min("y"), F.lit(south), F.lit(north)) - pad_bottom).alias("y_min"),
        (F.greatest(F.max("y"), F.lit(south), F.lit(north)) + pad_top).alias("y_max"),
    )


def by_share(df: DataFrame, key: str) -> DataFrame:
    """Rows and percent for each key."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total")))).select(key, "n", share(F.col("n"), F.col("total")).alias("pct"))


def cohort_layers(footprints: DataFrame, cohorts: dict[str, DataFrame], key: str = "stem") -> DataFrame:
    """Footprints that are in a cohort's list of stems, once for each cohort, with its name as layer."""
    layers = None
    for name, stems in cohorts.items():
        layer = footprints.join(stems.select(key).distinct(), key, "left_semi").withColumn("layer", F.lit(name))
        layers = layer if layers is None else layers.unionByName(layer)
    if layers is None:
        raise ValueError("no cohorts")
    return layers


def zoom_window(points: DataFrame, width: float = 130.0, height: float = 75.0, share_x: float = 0.28, below: float = 5.0) -> DataFrame:
    """One row: the window of the detail map over points(x, y) in metres, and how many points it holds.

    It begins at a share of the points' breadth and a little below them; no points give nulls.
    """
    corner = points.agg((F.min("x") + (F.max("x") - F.min("x")) * share_x).alias("x_min"), (F.min("y") - below).alias("y_min"))
    window = corner.withColumns({"x_max": F.col("x_min") + width, "y_max": F.col("y_min") + height})
    inside = F.col("x").between(F.col("x_min"), F.col("x_max")) & F.col("y").between(F.col("y_min"), F.col("y_max"))
    held = points.select("x", "y").crossJoin(F.broadcast(window)).agg(F.count_if(inside).alias("n"))
    return window.crossJoin(F.broadcast(held)).select("x_min", "x_max", "y_min", "y_max", "n")


def with_total(df: DataFrame, key: str) -> DataFrame:
    """Rows for each value of key, and in total."""
    counts = df.groupingSets([[key], []], key).agg(F.coalesce(F.col(key), F.lit("total")).alias("layer"), F.count("*").alias("n"))
    return counts.select("layer", "n")


def with_combined(df: DataFrame, key: str, name: str) -> DataFrame:
    """Each row in the layer of its key and in the layer of all."""
    return df.withColumn(name, F.explode(F.array(F.col(key), F.lit("all"))))


def distillation_layers(allocated: DataFrame, unlabelled: DataFrame, key: str = "image_name", cell: float = 8.0) -> DataFrame:
    """(key, campaign, layer): labelled training tiles, unlabelled ones that touch neither validation nor test, and these two."""
    columns = [key, "campaign"]
    held = allocated.where("split <> 'train'")
    safe = unlabelled.join(touching(unlabelled, held, key, cell), key, "left_anti").select(*columns, F.lit("safe_unlabeled").alias("layer"))
    layer = F.when(F.col("split") == "train", "labeled_train").otherwise(F.col("split"))
    return allocated.select(*columns, layer.alias("layer")).unionByName(safe)


def selected_parents(tiles: DataFrame, cameras: DataFrame) -> DataFrame:
    """Distinct parents of tiles that have a camera, matched as written."""
    return tiles.select("parent_image").distinct().join(cameras.select(F.col("label").alias("parent_image")).distinct(), "parent_image", "left_semi")
