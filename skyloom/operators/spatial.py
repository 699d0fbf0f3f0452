"""Spatial joins by grid cells, and ranks without a single task."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.session import materialize


def gridded(df: DataFrame, size: Column | float) -> DataFrame:
    """A row for each cell (gx, gy) that the bounds x0, y0, x1, y1 touch."""
    cells = lambda low, high: F.sequence(F.floor(F.col(low) / size), F.floor(F.col(high) / size))
    return df.withColumn("gx", F.explode(cells("x0", "x1"))).withColumn("gy", F.explode(cells("y0", "y1")))


#: Sides up to so many cells are dealt to cells of level 0.
WIDE = 4


def _level(size: float, wide: int = WIDE) -> Column:
    """0 for usual bounds, else the level at whose cells, 2^level times as wide, the longer side spans one to two."""
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) / size
    return F.when(side > wide, F.ceil(F.log2(side))).otherwise(0).cast("int")


BOUNDS = ("x0", "y0", "x1", "y1")


def _by_level(left: DataFrame, right: DataFrame, size: float) -> Iterator[tuple[DataFrame, DataFrame, float]]:
    """(rows of left, rows of right, side of a cell), so that each pair stands in one of them: that of its larger row's level."""
    a, b = (df.withColumn("__level", _level(size)) for df in (left, right))
    wide = [df.where("__level > 0").select("__level", F.lit(i).alias("__of")) for i, df in enumerate((a, b))]
    found = wide[0].unionByName(wide[1]).distinct().collect()
    levels = [{r[0] for r in found if r[1] == i} for i in (0, 1)]
    parts = [(a.where("__level = 0"), b.where("__level = 0"), 0)]
    for level in sorted(levels[0] | levels[1]):
        if level in levels[0]:
            parts.append((a.where(F.col("__level") == level), b.where(F.col("__level") <= level), level))
        if level in levels[1]:
            parts.append((a.where(F.col("__level") < level), b.where(F.col("__level") == level), level))
    for some, others, level in parts:
        yield some.drop("__level"), others.drop("__level"), size * 2.0**level


def _meet(one: str, other: str, closed: bool) -> Column:
    """Whether the bounds in columns with these prefixes intersect."""
    less = (lambda a, b: F.col(a) <= F.col(b)) if closed else (lambda a, b: F.col(a) < F.col(b))
    return less(f"{one}x0", f"{other}x1") & less(f"{other}x0", f"{one}x1") & less(f"{one}y0", f"{other}y1") & less(f"{other}y0", f"{one}y1")


def _dealt(df: DataFrame, side: float, prefix: str) -> DataFrame:
    """gridded() with all columns prefixed but the cell."""
    return gridded(df, side).select("gx", "gy", *(F.col(c).alias(f"{prefix}{c}") for c in df.columns))


def _near(left: DataFrame, right: DataFrame, side: float, closed: bool) -> tuple[DataFrame, DataFrame]:
    """Both tables dealt to cells (l_, r_), without rows that lie outside the bounds of all rows of the other table in the cell.

    The bounds are a row a cell, so that large tables of which little meets are not shuffled.
    """
    rows = [_dealt(df, side, p) for df, p in ((left, "l_"), (right, "r_"))]
    ends = {"x0": F.min, "y0": F.min, "x1": F.max, "y1": F.max}
    bounds = [df.groupBy("gx", "gy").agg(*(f(f"{p}{c}").alias(f"__{p}{c}") for c, f in ends.items())) for df, p in zip(rows, ("l_", "r_"), strict=True)]
    cells = materialize(bounds[0].join(bounds[1], ["gx", "gy"]).where(_meet("__l_", "__r_", closed)))
    of = lambda p: cells.select("gx", "gy", *(f"__{p}{c}" for c in BOUNDS))
    near = [df.join(of(q), ["gx", "gy"]).where(_meet(p, f"__{q}", closed)).select(*df.columns) for df, p, q in zip(rows, ("l_", "r_"), ("r_", "l_"), strict=True)]
    return near[0], near[1]


def box_pairs(left: DataFrame, right: DataFrame, size: float, closed: bool = True, apart: bool = False) -> DataFrame:
    """Pairs of rows whose bounds intersect: every pair once, by an equi-join on cells.

    Columns are prefixed with l_ and r_. A pair that shares several cells is taken
    in the cell of its greater lower corners alone, so nothing is deduplicated.
    Touching bounds count if closed. Cells of a usual footprint's side make the fewest
    candidates. Larger bounds go to levels of wider cells, few of each: a pair meets at
    the level of its larger row, where only rows of that level stand on one side, so
    that small rows are never paired in the cells of large ones. With apart, rows far
    from the other table are dropped first, which pays where few rows meet.
    """
    return reduce(DataFrame.unionByName, [_pairs_at(a, b, side, closed, apart) for a, b, side in _by_level(left, right, size)])


def _pairs_at(left: DataFrame, right: DataFrame, side: float, closed: bool, apart: bool) -> DataFrame:
    """box_pairs() in the cells of one level."""
    a, b = _near(left, right, side, closed) if apart else (_dealt(left, side, "l_"), _dealt(right, side, "r_"))
    owner = (F.col("gx") == F.floor(F.greatest("l_x0", "r_x0") / side)) & (F.col("gy") == F.floor(F.greatest("l_y0", "r_y0") / side))
    return a.join(b, ["gx", "gy"]).where(owner & _meet("l_", "r_", closed)).drop("gx", "gy")


#: Rows of a cell that the first round of touching() tries.
FIRST = 4


def touching(left: DataFrame, right: DataFrame, key: str, size: float, closed: bool = True, columns: tuple[str, ...] = (), where: Column | None = None, first: int = FIRST) -> DataFrame:
    """Distinct keys of left rows whose bounds intersect a row of right, and that meet `where` with it.

    `where` is on l_ and r_ columns: the bounds and `columns`. Each left row needs one
    partner, not all: in rounds it tries a few rows of its cells, then four times as
    many each round, and leaves at its first hit. Where many rows lie upon each other,
    most leave in the first round, and the work grows with the rows rather than with
    their pairs; rows without a partner try all rows of their cells that reach them.
    """
    rows = left.select(key, *BOUNDS, *columns).withColumnRenamed(key, "__key"), right.select(*BOUNDS, *columns)
    test = _meet("l_", "r_", closed) if where is None else _meet("l_", "r_", closed) & where
    found = [hits for a, b, side in _by_level(*rows, size) for hits in _touching_at(a, b, side, closed, test, first)]
    keys = reduce(DataFrame.unionByName, found) if found else rows[0].select(F.col("__key").alias("l___key")).limit(0)
    return keys.select(F.col("l___key").alias(key)).distinct()


def _touching_at(left: DataFrame, right: DataFrame, side: float, closed: bool, test: Column, first: int) -> list[DataFrame]:
    """The keys that each round of touching() finds in the cells of one level."""
    a, b = _near(left, right, side, closed)
    number = F.row_number().over(Window.partitionBy("gx", "gy").orderBy(F.xxhash64(*(c for c in b.columns if c not in ("gx", "gy")))))
    # rounds of first, 4 first, 16 first ... rows; each row is in one, wherever rounding puts it
    tried = materialize(b.withColumn("__round", F.floor(F.log(4.0, (number - 1) * (3.0 / first) + 1)).cast("int")))
    last = tried.agg(F.max("__round")).first()[0]
    if last is None:
        return []
    # rows of a few cells often lie in one file, as ranks are sorted by place; a number, as few bytes may be much work
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    going, found = materialize(a.repartition(parts, "l___key")), []
    for turn in range(last + 1):
        found.append(materialize(going.join(tried.where(F.col("__round") == turn), ["gx", "gy"]).where(test).select("l___key").distinct()))
        if turn < last:
            going = materialize(going.join(found[-1], "l___key", "left_anti"))
            if going.isEmpty():
                break
    return found


def ranked(df: DataFrame, *keys: Column, name: str = "rank") -> DataFrame:
    """Rank from 1 by unique keys, over the whole table.

    Rows are range-partitioned and sorted; each partition's count is added up over
    the partitions before it. The ids are written, so that they stay as they are.
    """
    placed = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", 33)
    # one row a partition
    sizes = sorted((r.p, r.n) for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    if not sizes:
        return placed.withColumn(name, F.lit(0).cast("long")).drop("__id")
    before, total = [0] * (sizes[-1][0] + 1), 0
    for p, n in sizes:
        before[p] = total
        total += n
    # an array, as a map would be searched for each row
    offsets = F.array(*(F.lit(x).cast("long") for x in before))
    return placed.withColumn(name, F.get(offsets, part.cast("int")) + F.col("__id").bitwiseAND((1 << 33) - 1) + 1).drop("__id")
