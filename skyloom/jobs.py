"""The stages as jobs over files; python -m skyloom <stage> runs one."""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import config
from skyloom.functions import projection, ring
from skyloom.functions.text import match_key, stem
from skyloom.operators import analytics, curate, georeference, slicing, stratify, testset
from skyloom.session import materialize, scratch
from skyloom.sources import files, photos, sinks, survey, yolo


def slice_photos(spark: SparkSession, c: config.Slicing) -> DataFrame:
    """Cut photos to tiles; writes tiles and labels as Parquet, image and label files and slice_metadata.json, and returns the tiles."""
    listed = files.photos(spark, c.input_dir).select(F.col("stem").alias("parent_image"), "split", "path")
    base = f"{c.input_dir}/images" if files.exists(spark, f"{c.input_dir}/images") else c.input_dir
    splits = [s for s in files.SPLITS if files.exists(spark, f"{base}/{s}")] or [""]
    stated = None
    for split in splits:
        found = photos.sizes(spark, f"{base}/{split}" if split else base).withColumn("split", F.lit(split))
        stated = found if stated is None else stated.unionByName(found)
    sizes = materialize(stated.join(listed.select("parent_image", "split").distinct(), ["parent_image", "split"], "left_semi").select("parent_image", "split", "w", "h"))
    labels = None
    base_labels = f"{c.input_dir}/labels" if files.exists(spark, f"{c.input_dir}/labels") else c.input_dir
    for split in splits:
        found = yolo.boxes(spark, f"{base_labels}/{split}" if split else base_labels).withColumn("split", F.lit(split))
        labels = found if labels is None else labels.unionByName(found)
    # the split is part of the key, so that equal names in two splits stay apart
    keyed = sizes.withColumn("parent_image", F.concat_ws("\0", "split", "parent_image"))
    boxes = labels.withColumn("parent_image", F.concat_ws("\0", "split", "stem")).drop("split", "stem")
    cut = materialize(slicing.tile_labels(keyed, boxes, c.slice_size, c.overlap_ratio, c.min_area_ratio, keep=("line_no",)))
    tiles = slicing.with_background(slicing.tile_grid(keyed, c.slice_size, c.overlap_ratio), cut, c.background_probabilities)
    contents = tiles.select("tile").join(yolo.label_text(cut), "tile", "left").select("tile", F.coalesce("content", F.lit("")).alias("content"))
    wanted = materialize(tiles.join(contents, "tile"))
    # each photo is decoded once, here; tiles of those that turn out to be broken behind their header go
    done = None
    for split in splits:
        crops = wanted.where(F.col("split_source") == split).groupBy(_plain("parent_image").alias("parent_image")).agg(F.collect_list(F.struct("x_start", "y_start", "x_end", "y_end", _plain("tile").alias("tile"))).alias("crops"))
        images = f"{c.output_dir}/tile_images/split={split or 'all'}"
        photos.cut(photos.read(spark, f"{base}/{split}" if split else base), crops).write.mode("overwrite").parquet(images)
        found = spark.read.parquet(images)
        sinks.image_files(spark, found, f"{c.output_dir}/images/{split}" if split else f"{c.output_dir}/images", ".png")
        names = found.select(F.concat(F.lit(f"{split}\0"), "tile").alias("tile"))
        done = names if done is None else done.unionByName(names)
    kept = materialize(wanted.join(done, "tile", "left_semi").withColumns({n: _plain(n) for n in ("tile", "parent_image")}))
    cut.join(done, "tile", "left_semi").withColumn("tile", _plain("tile")).write.mode("overwrite").parquet(f"{c.output_dir}/tile_labels")
    kept.drop("content").write.mode("overwrite").parquet(f"{c.output_dir}/tiles")
    for split in splits:
        sinks.label_files(spark, kept.where(F.col("split_source") == split), f"{c.output_dir}/labels/{split}" if split else f"{c.output_dir}/labels")
    sinks.slice_metadata(kept, f"{c.output_dir}/slice_metadata.json")
    return kept.drop("content")


def _plain(name: str) -> Column:
    """A name without the split that makes it unique."""
    return F.regexp_replace(name, "^[^\\x00]*\\x00", "")


def raycast(spark: SparkSession, c: config.Raycasting, cell: float = 16.0) -> DataFrame:
    """Tile corners to footprints; writes Parquet, GeoJSON and CSV, and returns the footprints."""
    tiles = survey.slice_metadata(spark, c.metadata_path).withColumn("parent_key", match_key(F.col("parent_image")))
    hits = None
    for campaign in c.campaigns:
        cameras = survey.cameras(spark, campaign.xml_path).crossJoin(F.broadcast(survey.component(spark, campaign.xml_path)))
        vertices, triangles = survey.mesh(spark, campaign.mesh_path)
        triangles = materialize(triangles)
        rays = georeference.rays(georeference.corners(tiles).join(cameras, "parent_key"), c.utm_epsg)
        rays = materialize(rays.select("tile", "corner_ord", "ox", "oy", "oz", "dx", "dy", "dz"))
        found = georeference.mesh_hits(rays, triangles, ["tile", "corner_ord"], cell).select("tile", "corner_ord", F.struct("x", "y", "z").alias("hit"))
        level = georeference.mesh_centre(vertices).select(F.col("z").alias("level"))
        both = rays.join(found, ["tile", "corner_ord"], "left").crossJoin(F.broadcast(level)).withColumn("place", F.coalesce("hit", georeference.plane_hit(F.col("level"))))
        rows = both.select("tile", F.lit(campaign.name).alias("campaign"), F.lit(campaign.campaign_ord).alias("campaign_ord"), "corner_ord", "place.x", "place.y", "place.z", F.col("hit").isNull().alias("fallback"))
        hits = rows if hits is None else hits.unionByName(rows)
    if hits is None:
        raise ValueError("no campaigns")
    prints = materialize(georeference.footprints(hits, c.utm_epsg))
    prints.write.mode("overwrite").parquet(f"{c.export_dir}/footprints")
    georeference.wide_corners(prints).write.mode("overwrite").option("header", True).csv(f"{c.export_dir}/image_edge_coordinates")
    sinks.features(prints, f"{c.export_dir}/image_footprints.geojson")
    return prints


def metric(prints: DataFrame, epsg: int) -> DataFrame:
    """Footprints in degrees (ring) to measured footprints in metres; lon_lat keeps the degrees."""
    rows = prints.withColumn("__id", F.monotonically_increasing_id())
    corners = rows.select("__id", F.posexplode("ring").alias("pos", "p")).select("__id", "pos", "p.x", "p.y")
    moved = projection.with_utm(corners, F.col("x"), F.col("y"), epsg=epsg)
    rings = moved.groupBy("__id").agg(F.array_sort(F.collect_list(F.struct("pos", "easting", "northing"))).alias("r"))
    utm = F.transform("r", lambda p: F.struct(p["easting"].alias("x"), p["northing"].alias("y")))
    joined = materialize(rows.withColumnRenamed("ring", "lon_lat")).join(rings.select("__id", utm.alias("ring")), "__id").drop("__id")
    return stratify.with_measures(joined)


def stratify_dataset(spark: SparkSession, c: config.Stratification) -> DataFrame:
    """Cohorts without leaks; writes the allocation, its summary, the dropped names, data.yaml and the cohorts' files, and returns the allocation."""
    prints = materialize(metric(survey.footprints(spark, c.geojson_path), c.utm_epsg))
    sized = stratify.drop_oversized(prints, c.max_oversized_pct)
    allocated = materialize(stratify.spatial_split(sized, c.split_ratio))
    flagged = materialize(stratify.with_leaks(allocated, c.max_overlap_pct))
    kept, dropped = flagged.where("not leaks").drop("leaks"), flagged.where("leaks")
    kept.write.mode("overwrite").parquet(f"{c.output_dir}/allocation")
    stratify.summary(prints, flagged).write.mode("overwrite").parquet(f"{c.output_dir}/summary")
    sinks.names(dropped, f"{c.output_dir}/dropped_images.txt")
    sinks.write_text(spark, f"{c.output_dir}/data.yaml", sinks.data_yaml(c.output_dir, list(c.classes)))
    if c.dataset_dir:
        copy_cohorts(spark, c.dataset_dir, c.output_dir, kept).write.mode("overwrite").parquet(f"{c.output_dir}/copy_audit")
    return kept


def copy_cohorts(spark: SparkSession, dataset_dir: str, output_dir: str, allocated: DataFrame) -> DataFrame:
    """Copy the images and labels of allocated(image_name, split) to <split>/images and <split>/labels; one row of counts.

    A tile without an image or without a label file is counted, not copied; failed counts files that could not be written.
    """
    wanted = allocated.select(stem(F.col("image_name")).alias("stem"), "split")
    images = materialize(files.listing(spark, f"{dataset_dir}/images", True).where(F.col("suffix").isin(*files.PHOTO_SUFFIXES)).select("stem", "path"))
    labels = materialize(files.listing(spark, f"{dataset_dir}/labels", True).where(F.lower("suffix") == ".txt").select("stem", "path"))
    manifest = curate.copy_manifest(wanted, images, labels)
    pairs = F.array(*(F.struct(F.col(f"{kind}_path").alias("source"), F.concat_ws("/", F.lit(output_dir), "split", F.lit(f"{kind}s"), F.regexp_extract(f"{kind}_path", "([^/]+)$", 1)).alias("target")) for kind in ("image", "label")))
    done = materialize(sinks.copy_files(manifest.select(F.inline(pairs))))
    return curate.allocation_audit(wanted, images, labels).crossJoin(done.agg(F.count_if(~F.col("copied")).alias("failed")))


def curate_dataset(spark: SparkSession, c: config.Curation) -> DataFrame:
    """The samples of a split dataset with places and map groups, as a table; returns it."""
    loaded = yolo.dataset(spark, c.folder_path).withColumn("tags", F.array("split"))
    missing = files.lines_of(spark, f"{c.folder_path}/missing_footprints.txt")
    # the log has the footprints' names; samples are stems
    dropped = files.lines_of(spark, f"{c.folder_path}/dropped_images.txt", as_stem=True)
    walked = files.listing(spark, f"{c.folder_path}/../sliced_dataset/images", True).where(F.col("suffix").isin(".jpg", ".jpeg", ".png", ".JPG", ".JPEG", ".PNG")).select("stem")
    extra = curate.injected(walked, dropped, missing, loaded, c.show_orphans).select("stem", "tags", F.lit(0).cast("long").alias("n_boxes"))
    samples = curate.with_groups(loaded.select("stem", "tags", "n_boxes").unionByName(extra), missing)
    prints = survey.footprints(spark, c.geojson_path)
    mean = ring.vertex_mean(F.col("ring"))
    places = prints.select(stem(F.col("image_name")).alias("stem"), mean.getField("x").alias("lon"), mean.getField("y").alias("lat"), "campaign", "ord")
    found = materialize(curate.with_places(samples, places))
    found.write.mode("overwrite").saveAsTable(c.dataset_name)
    curate.campaign_report(found).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{c.folder_path}/campaign_report")
    return found


def build_testset(spark: SparkSession, c: config.TestSet, allocation: DataFrame, unlabelled: DataFrame, dropped: DataFrame, south_limit: float = 5_332_400.0) -> DataFrame:
    """Test rows and background tiles that touch neither training footprints nor the buffer; writes and returns them.

    All tables are measured footprints in metres (metric()).
    """
    test, train = allocation.where("split = 'test'"), allocation.where("split = 'train'")
    corners = test.select(F.explode("ring").alias("p")).select("p.x", "p.y")
    candidates = testset.candidates(unlabelled, test, testset.convex_hull(corners))
    columns = ["image_name", "campaign", "ring", "x0", "y0", "x1", "y1", *(c for c in ("status", "lon_lat") if c in allocation.columns and c in unlabelled.columns)]
    pool = testset.combined(test.select(*columns), candidates.select(*columns))
    pure = materialize(testset.isolated(pool, train, testset.south_buffer(dropped, south_limit)))
    pure.write.mode("overwrite").parquet(f"{c.output_dir}/testset")
    return pure


def build_testset_files(spark: SparkSession, c: config.TestSet, classes: tuple[str, ...] = ("A. altissima",)) -> DataFrame:
    """The test-set stage over the folders of export_dir; writes images, labels, data.yaml and GeoJSON, and returns the rows.

    Images are copied, or cut from the raw photos where a tile was never written; all are named .jpg, whatever
    their format (J22, K09). Tiles without labels get empty label files, those without metadata or photo get no files (J16).
    """
    cohorts, background = f"{c.export_dir}/sliced_split_dataset", f"{c.export_dir}/sliced_unlabeled"
    labelled = metric(survey.footprints(spark, f"{c.export_dir}/sliced_dataset_edge_coordinates/image_footprints.geojson"), c.utm_epsg)
    named = materialize(labelled.withColumn("stem", stem(F.col("image_name"))))
    cohort = {s: named.join(files.listing(spark, f"{cohorts}/{s}/images").select("stem").distinct(), "stem", "left_semi").withColumn("split", F.lit(s)) for s in ("train", "test")}
    dropped = named.join(files.lines_of(spark, f"{cohorts}/dropped_images.txt", as_stem=True).distinct(), "stem", "left_semi")
    candidates = materialize(metric(survey.footprints(spark, f"{background}/edge_coordinates/image_footprints.geojson"), c.utm_epsg))
    pure = build_testset(spark, c, cohort["train"].unionByName(cohort["test"]), candidates, dropped)

    rows = materialize(pure.groupBy(stem(F.col("image_name")).alias("stem")).agg(F.max(F.col("slice_type") == "labeled_test").alias("labelled")))
    there = files.listing(spark, f"{background}/images").groupBy("stem").agg(F.max("path").alias("path"))
    known = rows.where("labelled").join(testset.first_extension(files.listing(spark, f"{cohorts}/test/images")), "stem").unionByName(rows.where("not labelled").join(there, "stem"))
    target = F.concat(F.lit(f"{c.output_dir}/images/"), F.col("stem"), F.lit(".jpg"))
    materialize(sinks.copy_files(known.select(F.col("path").alias("source"), target.alias("target"))))

    missing = rows.where("not labelled").join(there, "stem", "left_anti").select(F.col("stem").alias("tile"))
    ready = rows.where("labelled").select("stem").union(known.select("stem"))
    metadata = f"{background}/slice_metadata.json"
    if missing.limit(1).count() and files.exists(spark, metadata):
        raw = files.raw_photos(spark, c.raw_images_dir).withColumnRenamed("stem", "parent_image")
        crops = materialize(testset.crops(missing, survey.slice_metadata(spark, metadata), raw))
        # only the photos that have to give a tile are read; their paths pass through the driver, as in Spark's own file index
        if paths := [r.path for r in crops.select("path").collect()]:
            cut = materialize(photos.cut(photos.read(spark, paths), crops.select("parent_image", "crops")))
            sinks.image_files(spark, cut, f"{c.output_dir}/images", ".jpg")
            ready = ready.union(cut.select("tile"))
    lines = files.texts(spark, f"{cohorts}/test/labels").groupBy("stem").agg(F.max("content").alias("content"))
    contents = rows.join(ready.distinct(), "stem", "left_semi").join(lines, "stem", "left")
    sinks.label_files(spark, contents.select(F.col("stem").alias("tile"), F.when(F.col("labelled"), F.col("content")).alias("content")), f"{c.output_dir}/labels")
    sinks.write_text(spark, f"{c.output_dir}/data.yaml", sinks.data_yaml(c.output_dir, list(classes), {"test": "images"}))
    degrees = F.transform("lon_lat", lambda p: F.struct(p["x"].alias("lon"), p["y"].alias("lat")))
    sinks.features(pure.withColumn("corners", degrees), f"{c.output_dir}/testset_unlabeled_combined_footprints.geojson")
    return pure


def map_tables(spark: SparkSession, export_dir: str, out: str, epsg: int = 32633) -> None:
    """The tables behind the maps of all cohorts, as Parquet: splits_layer, composition, extent, and where there are unlabelled tiles, distillation."""
    cohorts, background = f"{export_dir}/sliced_split_dataset", f"{export_dir}/sliced_unlabeled/edge_coordinates/image_footprints.geojson"
    geojson = f"{export_dir}/sliced_dataset_edge_coordinates/image_footprints.geojson"
    if not files.exists(spark, geojson):
        raise FileNotFoundError(geojson)
    with scratch(spark):
        prints = materialize(metric(survey.footprints(spark, geojson), epsg).withColumn("stem", stem(F.col("image_name"))))
        held = {s: files.listing(spark, f"{cohorts}/{s}/images").select("stem") for s in files.SPLITS}
        held["buffer"] = files.lines_of(spark, f"{cohorts}/dropped_images.txt", as_stem=True)
        layers = materialize(analytics.cohort_layers(prints, held).select("image_name", "stem", "campaign", "layer", F.col("centroid_x").alias("x"), F.col("centroid_y").alias("y"), "x0", "y0", "x1", "y1", "ring"))
        tables = {
            "splits_layer": layers.select("image_name", "campaign", "layer", "x", "y"),
            "composition": layers.groupBy("layer", "campaign").agg(F.count("*").alias("n")),
            "extent": layers.agg(F.min("x").alias("x_min"), F.min("y").alias("y_min"), F.max("x").alias("x_max"), F.max("y").alias("y_max")),
        }
        if files.exists(spark, background):
            unlabelled = materialize(metric(survey.footprints(spark, background), epsg))
            tables["distillation"] = analytics.distillation_layers(layers.where("layer <> 'buffer'").withColumn("split", F.col("layer")), unlabelled)
        for name, frame in tables.items():
            frame.write.mode("overwrite").parquet(f"{out}/{name}")


def testset_map_tables(spark: SparkSession, export_dir: str, out: str, epsg: int = 32633) -> None:
    """The tables behind the test set's map, as Parquet: its centroids by layer, the window of the detail map, and the counts beside it."""
    folder = f"{export_dir}/testset_unlabeled_combined"
    geojson = f"{folder}/testset_unlabeled_combined_footprints.geojson"
    if not files.exists(spark, geojson):
        raise FileNotFoundError(geojson)
    with scratch(spark):
        lines = files.texts(spark, f"{folder}/labels").select("stem", F.size(F.filter(F.split("content", "\n"), lambda line: F.trim(line) != "")).cast("long").alias("n_boxes"))
        cohort = files.listing(spark, f"{export_dir}/sliced_split_dataset/test/images").select("stem").distinct().withColumn("labelled", F.lit(True))
        prints = metric(survey.footprints(spark, geojson), epsg).withColumn("stem", stem(F.col("image_name")))
        rows = prints.join(cohort, "stem", "left").join(lines.groupBy("stem").agg(F.max("n_boxes").alias("n_boxes")), "stem", "left")
        points = materialize(
            rows.select("image_name", "campaign", F.when(F.col("labelled"), "labeled_test").otherwise("unlabeled_test").alias("slice_type"), F.col("centroid_x").alias("x"), F.col("centroid_y").alias("y"), "n_boxes")
        )
        points.write.mode("overwrite").parquet(f"{out}/testset_points")
        analytics.zoom_window(points).write.mode("overwrite").parquet(f"{out}/testset_zoom")
        testset.metrics(points).write.mode("overwrite").parquet(f"{out}/testset_metrics")


def box_statistics(spark: SparkSession, dataset_dir: str, out: str, size: tuple[int, int] | None = None) -> None:
    """The tables behind the box dashboard, as Parquet; without a size, that of the first image that can be read."""
    if size is None:
        size = photos.size_of(spark, [f"{dataset_dir}/{path}" for s in files.SPLITS for path in (f"{s}/images", f"images/{s}")] + [f"{dataset_dir}/images", dataset_dir])
    samples = yolo.dataset(spark, dataset_dir)
    boxes = None
    for folder in files.label_folders(spark, dataset_dir).values():
        found = yolo.boxes(spark, folder, strict=False)
        boxes = found if boxes is None else boxes.unionByName(found)
    if boxes is None:
        raise FileNotFoundError(f"no labels in {dataset_dir}")
    sized = materialize(analytics.pixel_boxes(boxes, *size))
    for name, frame in {
        "fg_bg": curate.fg_bg(samples),
        "area_summary": analytics.area_summary(sized),
        "size_classes": analytics.size_classes(sized),
        "area_log_histogram": analytics.area_log_histogram(sized),
        "area_density": analytics.density(sized, "area_px", log=True),
        "heatmap": analytics.heatmap(sized),
    }.items():
        frame.write.mode("overwrite").parquet(f"{out}/{name}")


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="skyloom", description="Stages of an aerial-imagery dataset.")
    stages = parser.add_subparsers(dest="stage", required=True)

    def stage(name: str, **options: object) -> None:
        own = stages.add_parser(name)
        own.add_argument("--config")
        for option, kind in options.items():
            many = isinstance(kind, list)
            own.add_argument(f"--{option.replace('_', '-')}", type=kind[0] if many else kind, nargs="+" if many else None)

    stage("slice", input_dir=str, output_dir=str, slice_size=int, overlap_ratio=float, min_area_ratio=float, classes=[str], train_bg_prob=float, val_bg_prob=float, test_bg_prob=float)
    stage("raycast", metadata_path=str, export_dir=str, utm_epsg=int, campaign_config=str, xml_2023=str, mesh_2023=str, xml_2024=str, mesh_2024=str)
    stage("stratify", dataset_dir=str, output_dir=str, geojson_path=str, split_ratio=[float], max_overlap_pct=float, max_oversized_pct=float, classes=[str], utm_epsg=int)
    stage("curate", folder_path=str, geojson_path=str, dataset_name=str)
    stage("build-testset", export_dir=str, raw_images_dir=str, output_dir=str, utm_epsg=int)
    stage("maps", export_dir=str, output_dir=str, utm_epsg=int)
    stage("testset-map", export_dir=str, output_dir=str, utm_epsg=int)
    stage("box-stats", dataset_dir=str, output_dir=str, img_size=[int])
    given = vars(parser.parse_args(args))
    name, settings = given.pop("stage"), config.load(given.pop("config"))
    spark = SparkSession.builder.appName(f"skyloom {name}").getOrCreate()
    chosen = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if v is not None}
    if name == "slice":
        chances = {s: chosen.pop(f"{s}_bg_prob") for s in files.SPLITS if f"{s}_bg_prob" in chosen}
        slice_photos(spark, _over(settings.slicing, chosen | ({"background_probabilities": settings.slicing.background_probabilities | chances} if chances else {})))
    elif name == "raycast":
        path = chosen.pop("campaign_config", None)
        two = {year: {kind: chosen.pop(f"{kind}_{year}", None) for kind in ("xml", "mesh")} for year in ("2023", "2024")}
        chosen["campaigns"] = config.chosen_campaigns(settings.raycasting.campaigns, path, two)
        raycast(spark, _over(settings.raycasting, chosen))
    elif name == "stratify":
        stratify_dataset(spark, _over(settings.stratification, chosen))
    elif name == "curate":
        curate_dataset(spark, _over(settings.curation, chosen))
    elif name == "build-testset":
        build_testset_files(spark, _over(settings.testset, chosen), settings.stratification.classes)
    elif name in ("maps", "testset-map"):
        job = map_tables if name == "maps" else testset_map_tables
        job(spark, chosen.get("export_dir", settings.testset.export_dir), chosen.get("output_dir", f"{settings.base}/plots"), chosen.get("utm_epsg", settings.testset.utm_epsg))
    else:
        side = chosen.get("img_size")
        box_statistics(spark, chosen["dataset_dir"], chosen["output_dir"], side and (side if len(side) == 2 else (side[0], side[0])))


def _over(settings, chosen: dict):
    from dataclasses import replace

    return replace(settings, **chosen)
