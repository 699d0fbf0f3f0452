"""Tiles of photos as they arrive (an extension: SURVEY 2.12 lists no streaming).

The stream is stateless: a new photo's grid depends on nothing but its size, and its
labels on a static table of boxes. Ranks and the mean footprint are global, so cohorts
stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skyloom.operators.slicing import OVERLAP, TILE, tile_grid, tile_labels

PHOTOS = "parent_image string, w int, h int, split string"


def photo_stream(spark: SparkSession, landing: str, files_a_batch: int = 100) -> DataFrame:
    """photos(parent_image, w, h, split) from Parquet files that land in a folder."""
    return spark.readStream.schema(PHOTOS).option("maxFilesPerTrigger", files_a_batch).parquet(landing)


def start_tiling(photos: DataFrame, boxes: DataFrame, out: str, checkpoint: str, tile: int = TILE, overlap: float = OVERLAP) -> StreamingQuery:
    """Write the tiles and labels of each batch to <out>/tiles and <out>/labels.

    A batch goes to a folder of its own number, overwritten if it runs again, so that
    each photo's tiles are there once whatever fails.
    """

    def batch(rows: DataFrame, number: int) -> None:
        tile_grid(rows, tile, overlap).write.mode("overwrite").parquet(f"{out}/tiles/batch={number}")
        tile_labels(rows, boxes, tile, overlap).write.mode("overwrite").parquet(f"{out}/labels/batch={number}")

    return photos.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
