"""Listing of files, empty ones included.

Spark's file readers skip empty files, and an empty label file is what marks a
background tile. So names come from a listing of their own, contents from Spark's
readers, and a left join brings both together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.text import stem, strip
from skyloom.session import hadoop_path
from skyloom.sources.names import FileNames

#: Suffixes of photos, as written: case counts, but for raw photos, which are found whatever their case.
PHOTO_SUFFIXES = (".jpg", ".jpeg", ".png", ".tif", ".tiff", ".JPG", ".JPEG", ".PNG")
SPLITS = ("train", "val", "test")


def exists(spark: SparkSession, path: str) -> bool:
    where, system = hadoop_path(spark, path)
    return bool(system.exists(where))


def listing(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, name, stem, suffix, size) of the files in a folder; of none if it is absent.

    Folders that executors mount are listed by tasks, when the table is read; those
    of other stores by Hadoop's file system, so that their names pass through the driver.
    """
    where, system = hadoop_path(spark, path)
    if system.exists(where) and system.getUri().getScheme() == "file":
        spark.dataSource.register(FileNames)
        found = spark.read.format("file_names").option("recursive", recursive).load(system.makeQualified(where).toUri().getPath())
    else:
        rows: list[tuple[str, int]] = []
        if system.exists(where):
            files = system.listFiles(where, recursive)
            while files.hasNext():
                status = files.next()
                rows.append((status.getPath().toString(), status.getLen()))
        found = spark.createDataFrame(rows, "path string, size long")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return found.select("path", name.alias("name"), stem(name).alias("stem"), F.regexp_extract(name, r"(\.[^.]*)$", 1).alias("suffix"), "size")


def photos(spark: SparkSession, root: str) -> DataFrame:
    """Photo files by split: <root>/images/<split> for the splits that exist, else one flat split ''."""
    base = f"{root}/images" if exists(spark, f"{root}/images") else root
    splits = [s for s in SPLITS if exists(spark, f"{base}/{s}")] or [""]
    found = None
    for split in splits:
        files = listing(spark, f"{base}/{split}" if split else base).where(F.col("suffix").isin(*PHOTO_SUFFIXES)).withColumn("split", F.lit(split))
        found = files if found is None else found.unionByName(files)
    return found


def label_folders(spark: SparkSession, root: str) -> dict[str, str]:
    """Folder of labels by split: <root>/<split>/labels, else <root>/labels/<split>, else one 'all'."""
    found = {}
    for split in SPLITS:
        for path in (f"{root}/{split}/labels", f"{root}/labels/{split}"):
            if exists(spark, path):
                found[split] = path
                break
    if not found:
        flat = f"{root}/labels" if exists(spark, f"{root}/labels") else root
        if listing(spark, flat).where(F.col("suffix") == ".txt").limit(1).count():
            found["all"] = flat
    return found


def first_existing(spark: SparkSession, *paths: str) -> str | None:
    return next((p for p in paths if exists(spark, p)), None)


def _path(column: Column) -> Column:
    """A path without scheme and escapes, so that both readers' paths agree."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(column, r"\+", "%2B")), r"^[a-z]+:/{1,3}", "/")


def texts(spark: SparkSession, path: str, suffix: str = ".txt", recursive: bool = False) -> DataFrame:
    """(path, stem, content) of text files, '' for empty ones; bytes that are not UTF-8 are read as Latin-1."""
    files = listing(spark, path, recursive).where(F.lower("suffix") == suffix)
    if not files.limit(1).count():
        return files.select("path", "stem", F.lit("").alias("content"))
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)).load(path).select(_path(F.col("path")).alias("__path"), "content")
    body = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.decode("content", "UTF-8")).otherwise(F.decode("content", "ISO-8859-1"))
    return files.join(raw, _path(files["path"]) == raw["__path"], "left").select("path", "stem", F.coalesce(body, F.lit("")).alias("content"))


def lines_of(spark: SparkSession, path: str, as_stem: bool = False) -> DataFrame:
    """(stem) of a log with a name on each line; blank lines and an absent file give none."""
    if not exists(spark, path):
        return spark.createDataFrame([], "stem string")
    line = strip(F.col("value"))
    return spark.read.text(path).where(line != "").select((stem(line) if as_stem else line).alias("stem"))


def raw_photos(spark: SparkSession, root: str, exclude: str = "_export_data") -> DataFrame:
    """(stem, path) of photos anywhere below root but in excluded paths; of a repeated stem the greatest path."""
    found = listing(spark, root, True).where(F.lower("suffix").isin(*(s for s in PHOTO_SUFFIXES if s.islower())) & ~F.col("path").contains(exclude))
    return found.groupBy("stem").agg(F.max("path").alias("path"))
