"""The tile stream gives what the batch gives."""

from __future__ import annotations

from skyloom.operators.slicing import tile_grid, tile_labels
from skyloom.plans.views import view
from skyloom.streaming.tiles import photo_stream, start_tiling


def test_stream_is_the_batch(spark, sf_dir, tmp_path):
    photos = view(spark, sf_dir, "photos").select("parent_image", "w", "h", "split")
    boxes = view(spark, sf_dir, "boxes").select("parent_image", "class_id", "xc", "yc", "bw", "bh")
    photos.repartition(5).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        start_tiling(photo_stream(spark, str(tmp_path / "in"), 2), boxes, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    tiles = spark.read.parquet(str(tmp_path / "out/tiles")).drop("batch")
    labels = spark.read.parquet(str(tmp_path / "out/labels")).drop("batch")
    assert tiles.exceptAll(tile_grid(photos)).count() == tile_grid(photos).exceptAll(tiles).count() == 0
    assert labels.count() == tile_labels(photos, boxes).count()
