"""Camera XML, meshes, GeoJSON and tile metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.text import match_key
from skyloom.operators.georeference import last_of
from skyloom.sources.files import exists

_IDENTITY = [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]


def _elements(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path).withColumn("ord", F.monotonically_increasing_id())


def _floats(text):
    return F.transform(F.split(F.trim(text), r"\s+"), lambda v: v.cast("double"))


def sensors(spark: SparkSession, path: str) -> DataFrame:
    """(sensor_id, w, h, f, cx, cy) of sensors with resolution and calibration; of a repeated id the last."""
    schema = "_id string, resolution struct<_width:double,_height:double>, calibration array<struct<f:double,cx:double,cy:double>>"
    rows = _elements(spark, path, "sensor", schema).where("_id is not null and resolution is not null and calibration[0].f is not null")
    c = F.col("calibration")[0]
    found = rows.select(F.col("_id").alias("sensor_id"), F.col("resolution._width").alias("w"), F.col("resolution._height").alias("h"), c["f"].alias("f"), F.coalesce(c["cx"], F.lit(0.0)).alias("cx"), F.coalesce(c["cy"], F.lit(0.0)).alias("cy"), "ord")
    return last_of(found, "sensor_id", "ord").drop("ord")


def component(spark: SparkSession, path: str) -> DataFrame:
    """One row: the 4x4 matrix of the last component with rotation, translation and scale, or the identity."""
    schema = "transform struct<rotation:string,translation:string,scale:double>"
    rows = spark.read.format("xml").option("rowTag", "component").option("valueTag", "_VALUE").schema(schema.replace("rotation:string", "rotation:struct<_VALUE:string>").replace("translation:string", "translation:struct<_VALUE:string>").replace("scale:double", "scale:struct<_VALUE:double>")).load(path).withColumn("ord", F.monotonically_increasing_id())
    r, t, s = _floats(F.col("transform.rotation._VALUE")), _floats(F.col("transform.translation._VALUE")), F.col("transform.scale._VALUE")
    whole = rows.where("transform.rotation._VALUE is not null and transform.translation._VALUE is not null and transform.scale._VALUE is not null").select("ord", r.alias("r"), t.alias("t"), s.alias("s"))
    cell = lambda i: F.element_at("r", i + 1) * F.col("s")
    matrix = F.array(*(x for row in range(3) for x in (cell(3 * row), cell(3 * row + 1), cell(3 * row + 2), F.element_at("t", row + 1))), *(F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)))
    return whole.agg(F.coalesce(F.max_by(matrix, "ord"), F.array(*map(F.lit, _IDENTITY))).alias("component"))


def cameras(spark: SparkSession, path: str) -> DataFrame:
    """(parent_key, original_label, w, h, f, cx, cy, transform) of aligned cameras of known sensors; the last of a key."""
    rows = _elements(spark, path, "camera", "_label string, _sensor_id string, transform string").where("transform is not null and _label <> ''")
    known = rows.join(F.broadcast(sensors(spark, path)), rows["_sensor_id"] == F.col("sensor_id"))
    found = known.select(match_key(F.col("_label")).alias("parent_key"), F.col("_label").alias("original_label"), "w", "h", "f", "cx", "cy", _floats(F.col("transform")).alias("transform"), "ord")
    return last_of(found, "parent_key", "ord").drop("ord")


def references(spark: SparkSession, path: str) -> DataFrame:
    """(label, x, y, z) of cameras with a reference; z is 0 where it is missing."""
    rows = _elements(spark, path, "camera", "_label string, reference struct<_x:double,_y:double,_z:double>").where("reference is not null")
    return rows.select(F.col("_label").alias("label"), F.col("reference._x").alias("x"), F.col("reference._y").alias("y"), F.coalesce("reference._z", F.lit(0.0)).alias("z"))


def mesh(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vertices(vertex_id, x, y, z), triangles(face_id, a, b, c)) of an OBJ file.

    Faces may be polygons (cut as fans), carry texture and normal numbers, and count
    vertices from the end; a negative number counts the vertices written before it.
    """
    lines = spark.read.text(path).select(F.trim("value").alias("line"), F.monotonically_increasing_id().alias("ord"))
    parts = lines.select("ord", F.split("line", r"\s+").alias("p")).where(F.get("p", F.lit(0)).isin("v", "f"))
    # numbers within a file partition, then the counts of the partitions before it
    part = F.shiftright("ord", 33)
    counted = parts.withColumn("is_v", (F.get("p", F.lit(0)) == "v").cast("long")).withColumn("part", part)
    sizes = sorted((r.part, r.n) for r in counted.groupBy("part").agg(F.sum("is_v").alias("n")).collect())
    before, total = {}, 0
    for p, n in sizes:
        before[p] = total
        total += n
    from pyspark.sql import Window

    offset = F.element_at(F.create_map(*(F.lit(x).cast("long") for pair in before.items() for x in pair)), F.col("part")) if before else F.lit(0).cast("long")
    running = F.sum("is_v").over(Window.partitionBy("part").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)) + offset
    numbered = counted.withColumn("seen", running)
    vertices = numbered.where("is_v = 1").select(F.col("seen").alias("vertex_id"), *(F.get("p", F.lit(i)).cast("double").alias(c) for i, c in enumerate("xyz", 1)))
    corner = F.transform(F.slice("p", F.lit(2), F.size("p")), lambda t: F.split(t, "/")[0].cast("long"))
    faces = numbered.where("is_v = 0").select("ord", F.transform(corner, lambda i: F.when(i < 0, F.col("seen") + 1 + i).otherwise(i)).alias("v")).where(F.size("v") >= 3)
    fans = faces.select("ord", "v", F.posexplode(F.slice("v", F.lit(2), F.size("v") - 2)).alias("k", "v1")).select((F.col("ord") * 64 + F.col("k")).alias("face_id"), F.col("v")[0].alias("v0"), "v1", F.element_at("v", F.col("k") + 3).alias("v2"))
    found = fans
    for i, name in enumerate("abc"):
        side = vertices.select(F.col("vertex_id").alias(f"v{i}"), F.struct("x", "y", "z").alias(name))
        found = found.join(side, f"v{i}")
    return vertices, found.select("face_id", "a", "b", "c")


_FEATURE = "struct<geometry:struct<type:string,coordinates:string>,properties:struct<image_name:string,status:string,campaign:string>>"


def _features(spark: SparkSession, path: str) -> DataFrame:
    """(ord, f) of the features of a GeoJSON file.

    The text reader cuts the file at the features' type, in as many tasks as it has
    byte ranges; what follows a type is its feature's rest. The piece before the
    first type is none. Where another piece cannot be read (a type that is not the
    first member, or a name that is that word), the file is read as a whole.
    """
    pieces = spark.read.option("lineSep", '"Feature"').text(path).select(F.monotonically_increasing_id().alias("ord"), "value")
    parsed = pieces.select("ord", F.from_json(F.concat(F.lit('{"type": "Feature"'), F.col("value")), _FEATURE).alias("f"))
    whole = F.col("f.geometry").isNotNull() | F.col("f.properties").isNotNull()
    checked = parsed.where((F.col("ord") > 0) & ~F.coalesce(whole, F.lit(False))).limit(1).count()
    if not checked:
        return parsed.where(F.col("ord") > 0)
    rows = spark.read.option("multiLine", True).schema(f"features array<{_FEATURE}>").json(path)
    return rows.select(F.posexplode("features").alias("ord", "f")).withColumn("ord", F.col("ord").cast("long"))


def footprints(spark: SparkSession, path: str) -> DataFrame:
    """(image_name, status, campaign, ring, ord) of GeoJSON polygons with a name: outer ring, closing corner removed; an absent file has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], "image_name string, status string, campaign string, ring array<struct<x:double,y:double>>, ord long")
    good = _features(spark, path).where("f.geometry.type = 'Polygon' and f.properties.image_name is not null")
    outer = F.get(F.from_json("f.geometry.coordinates", "array<array<array<double>>>"), F.lit(0))
    ring = F.transform(outer, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    shut = F.get("ring", F.lit(0)) == F.element_at("ring", -1)
    found = good.select("f.properties.image_name", "f.properties.status", "f.properties.campaign", ring.alias("ring"), "ord")
    return found.withColumn("ring", F.when(shut & (F.size("ring") > 1), F.slice("ring", F.lit(1), F.size("ring") - 1)).otherwise(F.col("ring")))


def slice_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(tile, parent_image, x_start, y_start, x_end, y_end, split_source) of a JSON object by tile.

    An entry ends with the only brace in it, so the text reader cuts the file there,
    in as many tasks as it has byte ranges. Where a piece cannot be read (a name with
    a brace), the file is read as a whole.
    """
    entry = "map<string,struct<parent_image:string,x_start:int,y_start:int,x_end:int,y_end:int,split_source:string>>"
    rest = F.regexp_replace("value", r"^[\s,{]+", "")
    pieces = spark.read.option("lineSep", "}").text(path).select(rest.alias("rest")).where("rest <> ''")
    parsed = pieces.select(F.from_json(F.concat(F.lit("{"), F.col("rest"), F.lit("}}")), entry).alias("m"))
    if parsed.where("m is null or size(m) <> 1 or exists(map_values(m), t -> t is null)").limit(1).count():
        parsed = spark.read.text(path, wholetext=True).select(F.from_json("value", entry).alias("m"))
    return parsed.select(F.explode("m").alias("tile", "t")).select("tile", "t.*")
