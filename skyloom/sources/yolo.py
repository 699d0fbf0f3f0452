"""YOLO labels: a text file for each image, a box on each line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.text import strip
from skyloom.sources.files import label_folders, listing, texts


def _lines(files: DataFrame) -> DataFrame:
    rows = files.select("path", "stem", F.posexplode(F.split("content", r"\r\n|\n|\r")).alias("line_no", "line"))
    return rows.where(strip(F.col("line")) != "").withColumn("token", F.split(strip(F.col("line")), r"\s+"))


def boxes(spark: SparkSession, path: str, strict: bool = True, recursive: bool = False) -> DataFrame:
    """(stem, line_no, class_id, xc, yc, bw, bh) of lines with five numbers.

    Strict takes exactly five tokens; otherwise more are allowed and boxes without
    an area are dropped. rejects() has the other lines.
    """
    rows = _lines(texts(spark, path, recursive=recursive))
    good = rows.where(_good(strict))
    numbers = (_number(i).alias(n) for i, n in enumerate(("xc", "yc", "bw", "bh"), 1))
    found = good.select("stem", "line_no", F.get("token", F.lit(0)).alias("class_id"), *numbers)
    return found if strict else found.where((F.col("bw") > 0) & (F.col("bh") > 0))


def _number(i: int):
    return F.get("token", F.lit(i)).try_cast("double")


def _good(strict: bool):
    size = F.size("token") == 5 if strict else F.size("token") >= 5
    numbers = _number(1).isNotNull() & _number(2).isNotNull() & _number(3).isNotNull() & _number(4).isNotNull()
    return size & numbers


def rejects(spark: SparkSession, path: str, strict: bool = True, recursive: bool = False) -> DataFrame:
    """(stem, line_no, line) of lines that boxes() leaves out for their tokens."""
    return _lines(texts(spark, path, recursive=recursive)).where(~_good(strict)).select("stem", "line_no", "line")


def dataset(spark: SparkSession, root: str) -> DataFrame:
    """(stem, split, n_boxes, is_foreground) of every label file of the splits that exist.

    A file with a line is foreground, even if the line has no valid box.
    """
    found = None
    for split, folder in label_folders(spark, root).items():
        files = texts(spark, folder)
        n = boxes(spark, folder, strict=False).groupBy("stem").agg(F.count("*").alias("n_boxes"))
        rows = files.select("stem", (strip(F.col("content")) != "").alias("is_foreground")).join(n, "stem", "left")
        rows = rows.select("stem", F.lit(split).alias("split"), F.coalesce("n_boxes", F.lit(0)).cast("long").alias("n_boxes"), "is_foreground")
        found = rows if found is None else found.unionByName(rows)
    return found if found is not None else listing(spark, root).select("stem", F.lit("").alias("split"), F.lit(0).cast("long").alias("n_boxes"), F.lit(False).alias("is_foreground")).limit(0)


def label_text(labels: DataFrame) -> DataFrame:
    """(tile, content): the lines of each tile in order, six decimals, no newline at the end."""

    @F.arrow_udf("string")
    def line(kinds, *numbers):
        import pyarrow as pa

        return pa.array([f"{k} " + " ".join(f"{v:.6f}" for v in values) for k, *values in zip(kinds.to_pylist(), *(n.to_pylist() for n in numbers), strict=True)], pa.string())

    lines = labels.withColumn("line", line("class_id", "xc", "yc", "bw", "bh"))
    return lines.groupBy("tile").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]).alias("l")).select("tile", F.array_join("l", "\n").alias("content"))
