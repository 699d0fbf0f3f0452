"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from skyloom.catalogue import QUERIES
from skyloom.session import local_session

HEADLINE = (
    "tile_grid tile_labels tile_fg_bg_sampled label_stats_by_split box_area_summary box_area_log_hist box_center_heatmap spatial_split "
    "cross_split_pairs split_summary camera_precedence testset_pure ghosts_and_orphans sample_geo_enrich web_mercator_points ray_mesh_nearest"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()
    took: dict[str, float] = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
        print(name, took[name], file=sys.stderr)
    print(json.dumps({"metric": "headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rpartition("sf")[2]}))
    spark.stop()


if __name__ == "__main__":
    main()
