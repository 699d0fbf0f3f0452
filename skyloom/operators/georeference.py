"""Tile corners to ground footprints: cameras, rays, terrain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.projection import with_lon_lat, with_utm_of_ecef
from skyloom.session import materialize

#: Corners in order: top left, top right, bottom right, bottom left.
CORNERS = ("tl", "tr", "br", "bl")
EPSILON = 1e-6


def first_campaign(rows: DataFrame, *key: str) -> DataFrame:
    """For each key the row of the first campaign (W02); repeats within a campaign: the greatest row wins."""
    others = [c for c in rows.columns if c not in key]
    # the campaign first, then all columns, the other way round
    best = F.max(F.struct((-F.col("campaign_ord")).alias("__first"), *others))
    return rows.groupBy(*key).agg(best.alias("r")).select(*key, *(F.col(f"r.{c}") for c in others))


def last_of(rows: DataFrame, key: str, order: str) -> DataFrame:
    """For each key the last row by a unique order."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("r")).select(key, "r.*")


def corners(tiles: DataFrame) -> DataFrame:
    """Four rows a tile: corner_ord, px, py in the parent photo."""
    at = F.array(*(F.struct(F.lit(i).alias("corner_ord"), F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py")) for i, (x, y) in enumerate((("x_start", "y_start"), ("x_end", "y_start"), ("x_end", "y_end"), ("x_start", "y_end")))))
    return tiles.withColumn("c", F.explode(at)).select("*", "c.*").drop("c")


def times(matrix: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """A row-major 4x4 matrix times (x, y, z, 1), without its last row."""
    m = lambda i: F.element_at(matrix, i + 1)
    return tuple(m(4 * r) * x + m(4 * r + 1) * y + m(4 * r + 2) * z + m(4 * r + 3) for r in range(3))


def rays(points: DataFrame, epsg: int = 32633) -> DataFrame:
    """Add ox, oy, oz and the unit direction dx, dy, dz in UTM.

    points(px, py, w, h, f, cx, cy, transform, component): corners are normalised by
    the sensor's size and multiplied back, as the pixel's place in the sensor frame.
    """
    px, py = F.col("px") / F.col("w") * F.col("w"), F.col("py") / F.col("h") * F.col("h")
    xc = (px - (F.col("w") / 2.0 + F.col("cx"))) / F.col("f")
    yc = (py - (F.col("h") / 2.0 + F.col("cy"))) / F.col("f")
    one, zero = F.lit(1.0), F.lit(0.0)
    moved = points
    for name, (x, y, z) in (("p", (xc, yc, one)), ("o", (zero, zero, zero))):
        moved = moved.withColumn(f"__ray_{name}", F.array(*times(F.col("transform"), x, y, z)))
        moved = moved.withColumn(f"__ray_{name}", F.array(*times(F.col("component"), *(F.element_at(f"__ray_{name}", i) for i in (1, 2, 3)))))
        moved = with_utm_of_ecef(moved, *(F.element_at(f"__ray_{name}", i) for i in (1, 2, 3)), ("__e", "__n", "__h"), epsg)
        moved = moved.withColumn(f"__ray_{name}", F.array("__e", "__n", "__h")).drop("__e", "__n", "__h")
    return direction(moved, F.col("__ray_o"), F.col("__ray_p")).drop("__ray_o", "__ray_p")


def direction(df: DataFrame, origin: Column, target: Column) -> DataFrame:
    """Add the ray from origin through target (arrays of x, y, z)."""
    o, p = ([F.element_at(v, i) for i in (1, 2, 3)] for v in (origin, target))
    d = [b - a for a, b in zip(o, p, strict=True)]
    norm = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    return df.withColumns({**dict(zip(("ox", "oy", "oz"), o, strict=True)), **{n: v / norm for n, v in zip(("dx", "dy", "dz"), d, strict=True)}})


def plane_hit(z: Column) -> Column:
    """Where a ray meets the horizontal plane at z; null if it is level or leads away."""
    level = F.abs(F.col("dz")) < EPSILON
    t = (z - F.col("oz")) / F.when(~level, F.col("dz"))
    return F.when(t >= 0, F.struct((F.col("ox") + t * F.col("dx")).alias("x"), (F.col("oy") + t * F.col("dy")).alias("y"), (F.col("oz") + t * F.col("dz")).alias("z")))


def mesh_hits(ray_rows: DataFrame, triangles: DataFrame, key: list[str], cell: float, first: int = 3) -> DataFrame:
    """For each ray the nearest triangle in front of it, as x, y, z, t; rays without one are left out.

    triangles(face_id, a, b, c with x, y, z). Space is cut into cubes. A ray visits
    the cubes that it crosses inside the bounds of the mesh, level and upward rays
    too, from front to back in rounds: the first `first` ones, then four times as
    many each round. In a round, rays and triangles are joined on the cube, and the
    least distance wins (of faces at that distance, any). A ray whose hit lies
    before its next cube leaves, so what is behind the terrain makes no pairs. Each
    round writes its rays; there are log4 of the longest way's cubes. Both tables are
    read in each round: hand in written ones. Faces with the same corners count as one, that of the least face_id.
    """
    spark = ray_rows.sparkSession
    corner = {axis: [F.col(f"{v}.{axis}") for v in "abc"] for axis in "xyz"}
    extent = triangles.agg(*(e for axis, vs in corner.items() for e in (F.min(F.least(*vs)).alias(f"{axis}0"), F.max(F.greatest(*vs)).alias(f"{axis}1"))))
    dealt = triangles.groupBy("a", "b", "c").agg(F.min("face_id").alias("face_id"))
    for axis, vs in corner.items():
        low = F.floor(F.least(*vs) / cell)
        # up to the cube that the upper side is in or, if it is a cube's side, ends at: rays on a side visit both cubes
        dealt = dealt.withColumn(f"g{axis}", F.explode(F.sequence(low, F.greatest(low, F.ceil(F.greatest(*vs) / cell) - 1))))
    enters, leaves, between = [F.lit(0.0)], [], F.lit(True)
    for axis in "xyz":
        o, d = F.col(f"o{axis}"), F.col(f"d{axis}")
        # a little wider, for rounding at the mesh's edge; a ray along the other axes has to be between the two sides
        low, high = F.col(f"{axis}0") - EPSILON, F.col(f"{axis}1") + EPSILON
        along = F.when(d != 0, d)
        enters.append(F.least((low - o) / along, (high - o) / along))
        leaves.append(F.greatest((low - o) / along, (high - o) / along))
        between = between & ((d != 0) | o.between(low, high))
    ray = [f"{v}{c}" for v in "od" for c in "xyz"]
    bounded = ray_rows.crossJoin(F.broadcast(extent)).withColumns({"t0": F.greatest(*enters), "t1": F.least(*leaves)}).where(between & (F.col("t0") <= F.col("t1")))
    none = {"t": F.lit(None).cast("double"), "face_id": F.lit(None).cast(triangles.schema["face_id"].dataType)}
    going = bounded.select(*key, *ray, "t0", "t1").withColumns(none)
    # a cube's rays and triangles are small next to their pairs: a fixed number of partitions keeps all cores at work
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    start, size, ended = 0, first, []
    while True:
        cubes = _cubes(going, start, size, cell).repartition(parts, "gx", "gy", "gz")
        pairs = _with_distance(cubes.withColumnRenamed("t", "__t").withColumnRenamed("face_id", "__face").join(dealt, ["gx", "gy", "gz"], "left"))
        # plain minima, so that the aggregation hashes rather than sorts; the ray is the same in all its pairs. Misses (null t) stay
        met = pairs.groupBy(*key).agg(F.min("t").alias("t"), F.min_by("face_id", F.col("t")).alias("face_id"), *(F.min(c).alias(c) for c in (*ray, "t0", "t1", "__next", "__t", "__face")))
        nearer = F.col("__t").isNull() | (F.col("t") < F.col("__t"))
        best = met.withColumns({"t": F.when(nearer, F.col("t")).otherwise(F.col("__t")), "face_id": F.when(nearer & F.col("t").isNotNull(), F.col("face_id")).otherwise(F.col("__face"))})
        state = materialize(best.select(*key, *ray, "t0", "t1", "t", "face_id", "__next"))
        on = F.col("__next").isNotNull() & (F.col("t").isNull() | (F.col("t") > F.col("__next")))
        ended.append(state.where(~on & F.col("t").isNotNull()))
        going = state.where(on).drop("__next")
        if not going.limit(1).count():
            break
        start, size = start + size, 4 * size
    nearest = reduce(DataFrame.unionByName, ended)
    return nearest.select(*key, *((F.col(f"o{c}") + F.col("t") * F.col(f"d{c}")).alias(c) for c in "xyz"), "t", "face_id")


def _reached(o: Column, d: Column, cell: float):
    """Where a ray's way crosses the k-th side of the cubes on an axis."""
    return lambda k: F.greatest(F.col("t0"), F.least(F.col("t1"), (k * F.lit(cell) - o) / F.when(d != 0, d)))


def _cubes(rays_left: DataFrame, start: int, size: int, cell: float) -> DataFrame:
    """The cubes that each ray visits from the start-th of its way on, at most size; __next is where the one behind them begins.

    A ray's way from t0 to t1 is parted where it crosses a side of a cube. The cube
    of a part is that of its middle; a ray along a side visits the cubes on both.
    """
    crossed = [F.array("t0", "t1")]
    for axis in "xyz":
        o, d = F.col(f"o{axis}"), F.col(f"d{axis}")
        a, b = (o + F.col(t) * d for t in ("t0", "t1"))
        low, high = F.floor(F.least(a, b) / cell) + 1, F.ceil(F.greatest(a, b) / cell) - 1
        crossed.append(F.when((d != 0) & (low <= high), F.transform(F.sequence(low, high), _reached(o, d, cell))).otherwise(F.array().cast("array<double>")))
    cut = rays_left.withColumn("__cut", F.array_sort(F.concat(*crossed)))
    parts = cut.withColumns({"__next": F.when(F.size("__cut") > start + size + 1, F.get("__cut", F.lit(start + size))), "__cut": F.slice("__cut", start + 1, size + 1)})
    middles = F.transform(F.sequence(F.lit(0), F.size("__cut") - 2), lambda i: (F.get("__cut", i) + F.get("__cut", i + 1)) / 2)
    visits = parts.withColumn("__m", F.explode(middles)).drop("__cut")
    for axis in "xyz":
        at = F.col(f"o{axis}") + F.col("__m") * F.col(f"d{axis}")
        visits = visits.withColumn(f"g{axis}", F.explode(F.sequence(F.floor((at - EPSILON) / cell), F.floor((at + EPSILON) / cell))))
    return visits.drop("__m")


def _with_distance(pairs: DataFrame) -> DataFrame:
    """Add t, the distance along a ray to a triangle, null without a hit (Moeller and Trumbore 1997)."""

    def cross(u: list[Column], v: list[Column]) -> list[Column]:
        return [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]

    def dot(u: list[Column], v: list[Column]) -> Column:
        return u[0] * v[0] + u[1] * v[1] + u[2] * v[2]

    def named(name: str, vector: list[Column]) -> dict[str, Column]:
        return {f"{name}{c}": v for c, v in zip("xyz", vector, strict=True)}

    def of(name: str) -> list[Column]:
        return [F.col(f"{name}{c}") for c in "xyz"]

    sub = lambda p, q: [F.col(f"{p}.{c}") - F.col(f"{q}.{c}") for c in "xyz"]
    steps = pairs.withColumns(named("e", sub("b", "a")) | named("f", sub("c", "a")) | named("s", [F.col(f"o{c}") - F.col(f"a.{c}") for c in "xyz"]))
    steps = steps.withColumns(named("p", cross(of("d"), of("f"))) | named("q", cross(of("s"), of("e"))))
    steps = steps.withColumn("det", dot(of("e"), of("p")))
    inverse = 1.0 / F.when(F.abs(F.col("det")) > 1e-12, F.col("det"))
    steps = steps.withColumns({"u": dot(of("s"), of("p")) * inverse, "v": dot(of("d"), of("q")) * inverse, "t": dot(of("f"), of("q")) * inverse})
    return steps.withColumn("t", F.when((F.col("u") >= 0) & (F.col("v") >= 0) & (F.col("u") + F.col("v") <= 1) & (F.col("t") > 0), F.col("t")))


def mesh_centre(vertices: DataFrame) -> DataFrame:
    """One row: the middle of the mesh's bounds; its z serves as ground level."""
    return vertices.agg(*(((F.min(c) + F.max(c)) / 2).alias(c) for c in "xyz"))


def footprints(hits: DataFrame, epsg: int = 32633) -> DataFrame:
    """Tiles whose four corners all have a place: ordered corners in degrees, and status.

    hits(tile, campaign, campaign_ord, corner_ord, x, y, z, fallback); x is null where
    a corner has no place. Of several campaigns the first with four corners wins.
    """
    corner = F.struct("corner_ord", "lon", "lat", F.col("z").alias("alt"))
    tiles = with_lon_lat(hits, F.col("x"), F.col("y"), ("lon", "lat"), epsg).groupBy("tile", "campaign", "campaign_ord").agg(
        F.array_sort(F.collect_list(F.when(F.col("x").isNotNull(), corner))).alias("c"), F.max("fallback").alias("fallback")
    )
    whole = tiles.where(F.size("c") == 4).select(
        F.col("tile").alias("image_name"),
        "campaign",
        "campaign_ord",
        F.when(F.col("fallback"), "Mixed/Fallback").otherwise("Mesh Hit").alias("status"),
        F.transform("c", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"), p["alt"].alias("alt"))).alias("corners"),
    )
    return first_campaign(whole, "image_name")


def wide_corners(prints: DataFrame) -> DataFrame:
    """image_name, campaign and twelve columns tl_lon ... bl_alt."""
    return prints.select("image_name", "campaign", *(F.col("corners")[i][axis].alias(f"{name}_{axis}") for i, name in enumerate(CORNERS) for axis in ("lon", "lat", "alt")))
