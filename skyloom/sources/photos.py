"""Photos and the tiles cut from them.

Spark's image source decodes each photo once, in the task that reads it; the
tiles of a photo are cut in the same pass, and pixels are never shuffled. Sizes
come from the headers, without decoding.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.functions.text import stem
from skyloom.sources.files import exists

#: Crops up to which their lists are broadcast to the photos; beyond it, photos and lists are joined by a shuffle.
BROADCAST_CROPS = 1_000_000
#: Bytes of a file in which its size is looked for first; headers that are longer are read from the whole file.
HEAD = 65_536


def read(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, parent_image, w, h, channels, data) of the photos that can be decoded; rows of BGR bytes."""
    rows = spark.read.format("image").option("dropInvalid", True).load(path).select("image.*")
    name = F.url_decode(F.regexp_replace(F.regexp_extract("origin", r"([^/]+)$", 1), r"\+", "%2B"))
    return rows.select(F.col("origin").alias("path"), stem(name).alias("parent_image"), F.col("width").alias("w"), F.col("height").alias("h"), F.col("nChannels").alias("channels"), "data")


def header_size(data: bytes) -> tuple[int, int] | None:
    """Width and height that a PNG, JPEG, TIFF, GIF or BMP states; None if these bytes do not tell."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            found = struct.unpack_from(">II", data, 16)
        elif data[:6] in (b"GIF87a", b"GIF89a"):
            found = struct.unpack_from("<HH", data, 6)
        elif data[:2] == b"BM":
            width, height = struct.unpack_from("<ii", data, 18)
            found = width, abs(height)
        elif data[:4] in (b"II*\0", b"MM\0*"):
            found = _tiff_size(data, "<" if data[:1] == b"I" else ">")
        elif data[:2] == b"\xff\xd8":
            found = _jpeg_size(data)
        else:
            return None
    except (struct.error, IndexError):  # the bytes end before
        return None
    return found if found and min(found) > 0 else None


def _jpeg_size(data: bytes) -> tuple[int, int] | None:
    """From the first frame header (T.81, B.2.2); the segments before it are skipped by their lengths."""
    at = 2
    while data[at] == 0xFF:
        marker = data[at + 1]
        if marker == 0xFF:  # a fill byte
            at += 1
        elif marker == 1 or 0xD0 <= marker <= 0xD7:  # no length follows
            at += 2
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack_from(">HH", data, at + 5)
            return width, height
        else:
            at += 2 + struct.unpack_from(">H", data, at + 2)[0]
    return None


def _tiff_size(data: bytes, order: str) -> tuple[int, int] | None:
    """Fields 256 and 257 of the first directory (TIFF 6.0), short or long."""
    (at,) = struct.unpack_from(f"{order}I", data, 4)
    found = {}
    for i in range(struct.unpack_from(f"{order}H", data, at)[0]):
        tag, kind = struct.unpack_from(f"{order}HH", data, at + 2 + 12 * i)
        if tag in (256, 257) and kind in (3, 4):
            (found[tag],) = struct.unpack_from(order + ("H" if kind == 3 else "I"), data, at + 10 + 12 * i)
    return (found[256], found[257]) if len(found) == 2 else None


@F.arrow_udf(T.StructType([T.StructField("w", T.IntegerType()), T.StructField("h", T.IntegerType())]))
def _stated(heads: pa.Array) -> pa.Array:
    sizes = (header_size(h.as_buffer().to_pybytes()) if h.is_valid else None for h in heads)
    return pa.array([None if s is None else {"w": s[0], "h": s[1]} for s in sizes], pa.struct([("w", pa.int32()), ("h", pa.int32())]))


def sizes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, parent_image, w, h) of the photos whose header states a size; pixels are not decoded.

    Only the first HEAD bytes go to Python, and whole files only where these do not tell.
    """
    rows = spark.read.format("binaryFile").load(path).select("path", "content", _stated(F.substring("content", 1, HEAD)).alias("size"))
    whole = _stated(F.when(F.col("size").isNull() & (F.octet_length("content") > HEAD), F.col("content")))
    stated = rows.select("path", F.coalesce("size", whole).alias("size")).where("size is not null")
    name = F.url_decode(F.regexp_replace(F.regexp_extract("path", r"([^/]+)$", 1), r"\+", "%2B"))
    return stated.select("path", stem(name).alias("parent_image"), "size.w", "size.h")


def size_of(spark: SparkSession, folders: list[str], fallback: tuple[int, int] = (1024, 1024)) -> tuple[int, int]:
    """Width and height of the first photo that can be read in the first folder that has one."""
    for folder in folders:
        if exists(spark, folder):
            for r in sizes(spark, folder).select("w", "h").limit(1).collect():
                return r.w, r.h
    return fallback


def png(pixels: np.ndarray) -> bytes:
    """An image of (rows, columns, 1, 3 or 4) BGR bytes as PNG."""
    height, width, channels = pixels.shape
    ordered = pixels[:, :, [2, 1, 0, *range(3, channels)]] if channels > 2 else pixels
    rows = np.zeros((height, 1 + width * channels), np.uint8)
    rows[:, 1:] = ordered.reshape(height, -1)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def cut(photos: DataFrame, crops: DataFrame) -> DataFrame:
    """(tile, image) from photos and crops(parent_image, crops of x_start, y_start, x_end, y_end, tile).

    Windows are clamped to the photo; an empty one gives no tile. The lists of crops
    are counted first: up to BROADCAST_CROPS of them travel to the photos. Arrow
    batches end at spark.sql.execution.arrow.maxBytesPerBatch, or with one photo.
    """
    few = (crops.agg(F.sum(F.size("crops")).alias("n")).first().n or 0) <= BROADCAST_CROPS

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                w, h, channels = (row[c].as_py() for c in ("w", "h", "channels"))
                pixels = np.frombuffer(row["data"].as_buffer(), np.uint8).reshape(h, w, channels)
                for crop in row["crops"].as_py():
                    part = pixels[max(0, crop["y_start"]) : crop["y_end"], max(0, crop["x_start"]) : crop["x_end"]]
                    if part.size:
                        yield pa.RecordBatch.from_pydict({"tile": [crop["tile"]], "image": [png(part)]})

    return photos.join(F.broadcast(crops) if few else crops, "parent_image").select("w", "h", "channels", "data", "crops").mapInArrow(windows, "tile string, image binary")
