"""Geographic train, validation and test cohorts without leaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions import faces, ring
from skyloom.operators.spatial import BOUNDS, box_pairs, ranked, touching

RATIO = (0.86, 0.07, 0.07)
MAX_OVERSIZED_PCT = 600.0
MAX_OVERLAP_PCT = 0.0
#: Side of a grid cell in metres, about that of a usual footprint.
CELL = 8.0


def with_measures(footprints: DataFrame, ring_col: str = "ring") -> DataFrame:
    """Repair rings that meet themselves and add area_m2, centroid_x, centroid_y, bounds and repaired."""
    fixed = faces.repaired(footprints, ring_col)
    centre, box = ring.centroid(F.col(ring_col)), ring.bounds(F.col(ring_col))
    measured = fixed.withColumns({"area_m2": ring.area(F.col(ring_col)), "__c": centre, "__b": box})
    return measured.withColumns({"centroid_x": F.col("__c.x"), "centroid_y": F.col("__c.y"), **{c: F.col(f"__b.{c}") for c in ("x0", "y0", "x1", "y1")}}).drop("__c", "__b")


def area_limit(footprints: DataFrame, max_oversized_pct: float = MAX_OVERSIZED_PCT) -> DataFrame:
    """One row: mean_area over all footprints, and max_area."""
    mean = F.avg("area_m2")
    return footprints.agg(mean.alias("mean_area"), (mean * (1.0 + max_oversized_pct / 100.0)).alias("max_area"))


def drop_oversized(footprints: DataFrame, max_oversized_pct: float = MAX_OVERSIZED_PCT) -> DataFrame:
    """Footprints up to the limit; the one-row limit is broadcast."""
    return footprints.join(F.broadcast(area_limit(footprints, max_oversized_pct).select("max_area")), F.col("area_m2") <= F.col("max_area")).drop("max_area")


def spatial_split(footprints: DataFrame, ratio: tuple[float, float, float] = RATIO) -> DataFrame:
    """Add rank (south to north, then by name) and split; validation wins where cohorts meet."""
    placed = ranked(footprints, F.col("centroid_y"), F.col("image_name"))
    n = placed.agg(F.count("*").alias("n")).select(F.floor(F.col("n") * ratio[2]).alias("n_test"), F.floor(F.col("n") * ratio[1]).alias("n_val"), "n")
    cohort = F.when((F.col("n_val") > 0) & (F.col("rank") > F.col("n") - F.col("n_val")), "val").when(F.col("rank") <= F.col("n_test"), "test").otherwise("train")
    return placed.crossJoin(F.broadcast(n)).withColumn("split", cohort).drop("n", "n_test", "n_val")


def _measures(allocated: DataFrame) -> tuple[str, ...]:
    """The columns, besides the bounds, that an overlap is measured by."""
    return ("area_m2", *(["ring"] if "ring" in allocated.columns else []))


def _smaller() -> Column:
    return F.least("l_area_m2", "r_area_m2")


def _overlap_pct(allocated: DataFrame) -> Column:
    """The overlap of a pair in percent of the smaller footprint."""
    if "ring" in allocated.columns:
        common = ring.overlap_area(F.col("l_ring"), F.col("r_ring"))
    else:  # axis-aligned footprints
        common = (F.least("l_x1", "r_x1") - F.greatest("l_x0", "r_x0")) * (F.least("l_y1", "r_y1") - F.greatest("l_y0", "r_y0"))
    return common / _smaller() * 100.0


def cross_split_pairs(allocated: DataFrame, cell: float = CELL) -> DataFrame:
    """Train footprints and the val or test footprints they intersect, with the overlap in percent of the smaller."""
    rows = allocated.select("image_name", "split", *BOUNDS, *_measures(allocated))
    pairs = box_pairs(rows.where("split = 'train'"), rows.where("split <> 'train'"), cell, apart=True)
    return pairs.where(_smaller() > 0).select(
        F.col("l_image_name").alias("train_name"),
        F.col("r_image_name").alias("other_name"),
        F.col("r_split").alias("other_split"),
        _overlap_pct(allocated).alias("overlap_pct"),
    )


def _leaking(allocated: DataFrame, max_overlap_pct: float, closed: bool, cell: float) -> DataFrame:
    """Distinct names of train footprints that cross_split_pairs() has with more overlap, without making the pairs."""
    leaks = _smaller() > 0 if closed else (_smaller() > 0) & (_overlap_pct(allocated) > max_overlap_pct)
    return touching(allocated.where("split = 'train'"), allocated.where("split <> 'train'"), "image_name", cell, columns=_measures(allocated), where=leaks)


def allocation(allocated: DataFrame, max_overlap_pct: float = MAX_OVERLAP_PCT, closed: bool = False, cell: float = CELL) -> DataFrame:
    """Footprints whose name does not leak; with closed, touching counts as a leak."""
    return allocated.join(_leaking(allocated, max_overlap_pct, closed, cell), "image_name", "left_anti")


def with_leaks(allocated: DataFrame, max_overlap_pct: float = MAX_OVERLAP_PCT, cell: float = CELL) -> DataFrame:
    """Add leaks: whether allocation() drops the row."""
    names = _leaking(allocated, max_overlap_pct, False, cell).withColumn("__leaks", F.lit(True))
    return allocated.join(names, "image_name", "left").withColumn("leaks", F.col("__leaks").isNotNull()).drop("__leaks")


def with_leak_rows(allocated: DataFrame, max_overlap_pct: float = MAX_OVERLAP_PCT, cell: float = CELL) -> DataFrame:
    """image_name, split and leaks for summary(): the rows, and one without a split for each name that leaks, so that no join sorts the rows."""
    names = _leaking(allocated, max_overlap_pct, False, cell).where("image_name is not null")
    rows = allocated.select("image_name", "split", F.lit(False).alias("leaks"))
    return rows.unionByName(names.select("image_name", F.lit(None).cast("string").alias("split"), F.lit(True).alias("leaks")))


def summary(initial: DataFrame, flagged: DataFrame) -> DataFrame:
    """One row of counts of all footprints and of those of allowed size with leaks.

    Flagged is with_leaks() or with_leak_rows(): a name leaks if one of its rows does. Names are
    counted for retained and boundary_dropped, rows for the cohorts and oversized_dropped.
    """
    cohorts = ("train", "val", "test")
    names = flagged.groupBy("image_name").agg(F.max("leaks").alias("leaks"), F.count("split").alias("rows"), *(F.count_if(F.col("split") == s).alias(s) for s in cohorts))
    known = F.col("image_name").isNotNull()
    after = names.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("sized"),
        F.count_if(known & F.col("leaks")).alias("boundary_dropped"),
        F.count_if(known & ~F.col("leaks")).alias("retained"),
        *(F.coalesce(F.sum(F.when(~F.col("leaks"), F.col(s))), F.lit(0)).alias(s) for s in cohorts),
    )
    return initial.agg(F.count("*").alias("initial")).crossJoin(after).select(
        "initial",
        (F.col("initial") - F.col("sized")).alias("oversized_dropped"),
        "boundary_dropped", "retained", *cohorts,
        F.try_divide(F.col("retained") * 100.0, F.col("initial")).alias("retained_pct"),
    )
