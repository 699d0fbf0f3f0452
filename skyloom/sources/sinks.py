"""Files that other tools read: labels, GeoJSON, CSV, logs, YAML.

Parquet is what stages exchange; these are exports. One-file formats are written
as parts by the tasks, and the parts are then copied behind each other, as
streams: no row passes through the driver's memory.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions import ring
from skyloom.functions.text import fill_colour
from skyloom.session import hadoop_path, shared_dir


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """One small file, by Hadoop's file system."""
    where, system = hadoop_path(spark, path)
    out = system.create(where, True)
    try:
        out.write(bytearray(content.encode("utf-8")))
    finally:
        out.close()


def write_joined(rows: DataFrame, path: str, head: str = "", separator: str = "", tail: str = "") -> None:
    """One file of any size: head, the lines of rows(value) in their partitions' order with the separator between them, tail.

    Each line is written behind a separator; that of the very first line is skipped.
    The file appears under its name when it is whole.
    """
    spark = rows.sparkSession
    folder = f"{shared_dir(spark)}/skyloom-{uuid.uuid4().hex}"
    rows.select(F.concat(F.lit(separator), F.col("value"))).write.text(folder)
    parts, system = hadoop_path(spark, folder)
    where, target = hadoop_path(spark, path)
    half, _ = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.part")
    copy = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    out = target.create(half, True)
    try:
        out.write(bytearray(head.encode("utf-8")))
        skip = len(separator.encode("utf-8"))
        for found in sorted((f for f in system.listStatus(parts) if f.getPath().getName().startswith("part-") and f.getLen()), key=lambda f: f.getPath().getName()):
            source = system.open(found.getPath())
            try:
                source.seek(skip)
                copy(source, out, 1 << 20, False)
            finally:
                source.close()
            skip = 0
        out.write(bytearray(tail.encode("utf-8")))
    finally:
        out.close()
        system.delete(parts, True)
    if target.exists(where):
        target.delete(where, True)
    if not target.rename(half, where):
        raise OSError(f"{path} could not be written")


def features(prints: DataFrame, path: str) -> None:
    """Footprints(image_name, status, campaign, corners) as one GeoJSON file, by name; heights are dropped."""
    outer = F.transform(ring.closed(F.col("corners")), lambda p: F.array(p["lon"], p["lat"]))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), F.array(outer).alias("coordinates")).alias("geometry"),
        F.struct("image_name", "status", "campaign", fill_colour(F.col("image_name")).alias("fill"), F.lit(2).alias("stroke-width")).alias("properties"),
    )
    lines = prints.select("image_name", F.to_json(feature).alias("value")).orderBy("image_name", "value").select("value")
    write_joined(lines, path, '{"type": "FeatureCollection", "features": [\n', ",", "]}\n")


def slice_metadata(tiles: DataFrame, path: str) -> None:
    """The JSON object by tile, as one file (K03); of a name in several splits the greatest split counts."""
    one = tiles.groupBy("tile").agg(F.max_by(F.struct("parent_image", "x_start", "y_start", "x_end", "y_end", "split_source"), "split_source").alias("t"))
    entry = F.to_json(F.create_map("tile", "t"))
    write_joined(one.select(F.substring(entry, F.lit(2), F.length(entry) - 2).alias("value")), path, "{\n", ",", "}\n")


def names(rows: DataFrame, path: str) -> None:
    """A log with a name of rows(image_name) on each line, in order, each once."""
    write_joined(rows.select(F.col("image_name").alias("value")).distinct().orderBy("value"), path)


def data_yaml(root: str, classes: list[str], folders: dict[str, str] | None = None) -> str:
    """The dataset description that trainers read (K07); folders of images by split."""
    names = ", ".join("'" + c.replace("'", "''") + "'" for c in classes)
    listed = "".join(f"{s}: {f}\n" for s, f in (folders or {s: f"{s}/images" for s in ("train", "val", "test")}).items())
    return f"# YOLO dataset\npath: {root}\n{listed}\n# Classes\nnc: {len(classes)}\nnames: [{names}]\n"


def label_files(spark: SparkSession, contents: DataFrame, folder: str) -> None:
    """A file <tile>.txt for each row (tile, content), empty ones too, written by the tasks."""
    from skyloom.sources.writer import LabelWriter

    spark.dataSource.register(LabelWriter)
    contents.select("tile", "content").write.format("label_files").mode("append").save(folder)


def image_files(spark: SparkSession, images: DataFrame, folder: str, suffix: str) -> None:
    """A file <tile><suffix> for each row (tile, image), written by the tasks."""
    from skyloom.sources.writer import LabelWriter

    spark.dataSource.register(LabelWriter)
    images.select("tile", F.col("image").alias("content")).write.format("label_files").option("suffix", suffix).mode("append").save(folder)


def copy_files(manifest: DataFrame) -> DataFrame:
    """Copy source to target in the tasks, for folders that all executors mount; returns (target, copied).

    A target appears whole or not at all, however often its task runs.
    """

    @F.arrow_udf("boolean")
    def copied(sources, targets):
        import os
        import shutil

        import pyarrow as pa

        done = []
        for a, b in zip(sources.to_pylist(), targets.to_pylist(), strict=True):
            try:
                os.makedirs(os.path.dirname(b), exist_ok=True)
                shutil.copy2(a, f"{b}.{os.getpid()}.part")
                os.replace(f"{b}.{os.getpid()}.part", b)
                done.append(True)
            except OSError:
                done.append(False)
        return pa.array(done)

    mounted = [F.regexp_replace(c, "^file:/{1,3}", "/") for c in ("source", "target")]
    return manifest.select("target", copied(*mounted).alias("copied"))
