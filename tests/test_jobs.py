"""The stages end to end over small files."""

from __future__ import annotations

import json

import numpy as np
from test_sources import XML

from skyloom import config, jobs
from skyloom.sources.photos import png


def test_slice_then_box_statistics(spark, tmp_path):
    root = tmp_path / "in"
    for split in ("train", "val"):
        (root / "images" / split).mkdir(parents=True)
        (root / "labels" / split).mkdir(parents=True)
    pixels = np.arange(96 * 80 * 3, dtype=np.uint32).astype(np.uint8).reshape(80, 96, 3)
    (root / "images/train/A é.png").write_bytes(png(pixels))
    (root / "images/val/A é.png").write_bytes(png(pixels[:64, :64]))
    (root / "images/val/small.png").write_bytes(png(pixels[:10, :10]))
    (root / "images/val/bad.png").write_bytes(b"no image")
    (root / "images/val/broken.png").write_bytes(png(pixels[:64, :64])[:60])  # its header states a size, its pixels are lost
    (root / "labels/train/A é.txt").write_text("0 0.5 0.5 0.2 0.2\n1 0.1 0.1 0.1 0.1")
    out = tmp_path / "out"
    tiles = jobs.slice_photos(spark, config.Slicing(str(root), str(out), 64, 0.2, 0.2, ("a",), {"train": 1.0, "val": 1.0, "test": 1.0}))
    found = {(r.tile, r.split_source, r.is_foreground) for r in tiles.collect()}
    assert ("A é_0_0", "val", False) in found or ("A é_0_0", "val", True) in found
    assert {t for t, s, _ in found if s == "train"} == {"A é_0_0", "A é_32_0", "A é_0_16", "A é_32_16"}
    assert (out / "labels/train/A é_32_16.txt").read_text().startswith("0 0.250000")
    assert "A é_0_0" in {p.stem for p in (out / "labels/val").glob("*.txt")}
    assert not any("broken" in t for t, _, _ in found) and not list(out.glob("**/broken*"))
    assert set(json.loads((out / "slice_metadata.json").read_text())) == {t for t, _, _ in found}
    assert spark.read.parquet(str(out / "tile_images")).count() >= 4
    assert {p.stem for p in (out / "images/train").glob("*.png")} == {p.stem for p in (out / "labels/train").glob("*.txt")}
    jobs.box_statistics(spark, str(out), str(tmp_path / "stats"), (64, 64))
    assert spark.read.parquet(str(tmp_path / "stats/area_summary")).first().n > 0


def test_raycast_then_stratify(spark, tmp_path):
    pose = XML.replace("1 0 0 5 0 1 0 6 0 0 1 7 0 0 0 1", "1 0 0 0 0 1 0 0 0 0 1 0 0 0 0 1")
    # a component that stands at (48 N, 15 E), 300 m up, looking down
    lat, lon = np.radians(48.0), np.radians(15.0)
    up = np.array([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)])
    east = np.array([-np.sin(lon), np.cos(lon), 0.0])
    rotation = np.stack([east, -np.cross(up, east), -up], 1)
    from skyloom.functions.projection import E2, A

    n = A / np.sqrt(1 - E2 * np.sin(lat) ** 2)
    place = np.array([n * np.cos(lat) * np.cos(lon), n * np.cos(lat) * np.sin(lon), n * (1 - E2) * np.sin(lat)]) + 300 * up
    pose = pose.replace("0 -1 0 1 0 0 0 0 1", " ".join(map(repr, map(float, rotation.ravel())))).replace("10 20 30", " ".join(map(repr, map(float, place)))).replace('<scale locked="true">2', '<scale locked="true">1')
    (tmp_path / "c.xml").write_text(pose)
    (tmp_path / "m.obj").write_text("v 480000 5310000 20\nv 520000 5310000 20\nv 520000 5325000 20\nv 480000 5325000 20\nf 1 2 3 4\n")
    tiles = {f"IMG_1_{x}_0": {"parent_image": "IMG_1", "x_start": x, "y_start": 0, "x_end": x + 1024, "y_end": 1024, "split_source": ""} for x in range(0, 3000, 1000)}
    tiles["none_0_0"] = tiles["IMG_1_0_0"] | {"parent_image": "none"}
    (tmp_path / "slice_metadata.json").write_text(json.dumps(tiles))
    campaign = config.Campaign("2023", 0, str(tmp_path / "c.xml"), str(tmp_path / "m.obj"))
    prints = jobs.raycast(spark, config.Raycasting(str(tmp_path / "slice_metadata.json"), str(tmp_path / "export"), 32633, (campaign,)), cell=5000.0).collect()
    assert {r.image_name for r in prints} == {"IMG_1_0_0", "IMG_1_1000_0", "IMG_1_2000_0"}
    assert {r.status for r in prints} == {"Mesh Hit"}
    assert all(abs(c.alt - 20) < 1e-3 and abs(c.lon - 15) < 0.1 and abs(c.lat - 48) < 0.02 for r in prints for c in r.corners)
    geo = json.loads((tmp_path / "export/image_footprints.geojson").read_text())
    assert len(geo["features"]) == 3
    kept = jobs.stratify_dataset(spark, config.Stratification("", str(tmp_path / "split"), str(tmp_path / "export/image_footprints.geojson"), (0.3, 0.34, 0.34)))
    assert {r.split for r in kept.collect()} <= {"train", "val", "test"} and kept.count() >= 2
    assert "nc: 1" in (tmp_path / "split/data.yaml").read_text()


def test_stratify_then_curate(spark, tmp_path):
    """What the split drops comes back as ghosts, with the places of its footprints."""
    w, s = 15.0, 48.0
    geo = tmp_path / "f.geojson"
    # south to north; the training tile that overlaps the test tile goes
    _collection(geo, *(_square(f"T_{i}.jpg", w, s + y, w + 1e-4, s + y + 1e-4) for i, y in enumerate((0.0, 0.5e-4, 3e-4, 5e-4, 7e-4, 9e-4))))
    for kind, suffix, text in (("images", "jpg", "i"), ("labels", "txt", "0 0.5 0.5 0.1 0.1")):
        (tmp_path / "sliced_dataset" / kind).mkdir(parents=True)
        for i in range(6):
            (tmp_path / "sliced_dataset" / kind / f"T_{i}.{suffix}").write_text(text)
    out = tmp_path / "split"
    kept = jobs.stratify_dataset(spark, config.Stratification(str(tmp_path / "sliced_dataset"), str(out), str(geo), (0.6, 0.2, 0.2)))
    assert {r.image_name: r.split for r in kept.collect()} == {"T_0.jpg": "test", "T_2.jpg": "train", "T_3.jpg": "train", "T_4.jpg": "train", "T_5.jpg": "val"}
    assert (out / "dropped_images.txt").read_text() == "T_1.jpg\n"
    found = jobs.curate_dataset(spark, config.Curation(str(out), str(geo), "curated_samples"))
    rows = {r.stem: r for r in found.collect()}
    assert set(rows) == {f"T_{i}" for i in range(6)} and all(abs(r.lon - w) < 1e-3 for r in rows.values())
    ghost = rows["T_1"]
    assert ghost.tags != rows["T_2"].tags and ghost.map_group != rows["T_2"].map_group and rows["T_0"].split == "test"
    assert spark.table("curated_samples").count() == 6
    spark.sql("drop table curated_samples")


def _square(name: str, west: float, south: float, east: float, north: float) -> dict:
    ring = [[west, north], [east, north], [east, south], [west, south], [west, north]]
    return {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": {"image_name": name, "status": "Mesh Hit", "campaign": "2023"}}


def _collection(path, *squares) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"type": "FeatureCollection", "features": squares}))


def test_copy_of_cohorts(spark, tmp_path):
    for kind, names in (("images", ["a.png", "b.jpg", "c.JPG"]), ("labels", ["a.txt", "b.TXT", "x.txt"])):
        (tmp_path / "in" / kind / "all").mkdir(parents=True)
        for n in names:
            (tmp_path / "in" / kind / "all" / n).write_text(n)
    allocated = spark.createDataFrame([("a", "train"), ("b.png", "test"), ("c", "test"), ("d", "val")], "image_name string, split string")
    out = tmp_path / "out"
    assert jobs.copy_cohorts(spark, str(tmp_path / "in"), str(out), allocated).first() == (4, 1, 1, 2, 0)
    assert sorted(str(p.relative_to(out)) for p in out.rglob("*") if p.is_file() and not p.name.startswith(".")) == ["test/images/b.jpg", "test/labels/b.TXT", "train/images/a.png", "train/labels/a.txt"]
    assert (out / "test/images/b.jpg").read_text() == "b.jpg"


def test_testset_on_disk(spark, tmp_path):
    w, s = 15.0, 48.0
    split, background = tmp_path / "sliced_split_dataset", tmp_path / "sliced_unlabeled"
    _collection(
        tmp_path / "sliced_dataset_edge_coordinates/image_footprints.geojson",
        _square("T_0_0.jpg", w, s, w + 2e-4, s + 2e-4), _square("R_0_0", w + 3.5e-4, s, w + 5e-4, s + 2e-4), _square("D_0_0", w, s + 3e-4, w + 2e-4, s + 5e-4),
    )
    _collection(
        background / "edge_coordinates/image_footprints.geojson",
        _square("copied_0_0", w + 1e-4, s, w + 3e-4, s + 2e-4), _square("P_2_4", w + 5e-5, s, w + 1e-4, s + 1e-4), _square("lost_0_0", w, s, w + 1e-4, s + 1e-4),
        _square("at_train", w + 2e-4, s, w + 4e-4, s + 2e-4), _square("at_buffer", w, s + 1e-4, w + 2e-4, s + 4e-4), _square("far", w + 1e-2, s, w + 1.1e-2, s + 1e-4),
    )
    for folder in (split / "train/images", split / "test/images", split / "test/labels", background / "images", tmp_path / "raw/deep", tmp_path / "raw/_export_data"):
        folder.mkdir(parents=True)
    (split / "train/images/R_0_0.jpg").write_text("r")
    (split / "test/images/T_0_0.png").write_text("png")
    (split / "test/images/T_0_0.jpg").write_text("jpg")
    (split / "test/labels/T_0_0.txt").write_text("0 0.5 0.5 0.1 0.1")
    (split / "dropped_images.txt").write_text("D_0_0.jpg\n\n")
    (background / "images/copied_0_0.png").write_text("tile")
    pixels = (np.arange(20 * 30 * 3) % 251).astype(np.uint8).reshape(20, 30, 3)
    (tmp_path / "raw/deep/P.PNG").write_bytes(png(pixels))
    (tmp_path / "raw/_export_data/P.png").write_bytes(b"no image")
    at = {"parent_image": "P", "x_start": 2, "y_start": 4, "x_end": 12, "y_end": 14, "split_source": ""}
    (background / "slice_metadata.json").write_text(json.dumps({"P_2_4": at, "lost_0_0": at | {"parent_image": "none"}}))
    out = tmp_path / "testset"
    pure = jobs.build_testset_files(spark, config.TestSet(str(tmp_path), str(tmp_path / "raw"), str(out)))
    assert {(r.image_name, r.slice_type) for r in pure.collect()} == {("T_0_0.jpg", "labeled_test"), ("copied_0_0", "unlabeled_test"), ("P_2_4", "unlabeled_test"), ("lost_0_0", "unlabeled_test")}
    assert {p.name: p.read_text() for p in (out / "labels").glob("*.txt")} == {"T_0_0.txt": "0 0.5 0.5 0.1 0.1", "copied_0_0.txt": "", "P_2_4.txt": ""}
    assert {p.name for p in (out / "images").glob("*.jpg")} == {"T_0_0.jpg", "copied_0_0.jpg", "P_2_4.jpg"}
    assert (out / "images/T_0_0.jpg").read_text() == "jpg" and (out / "images/copied_0_0.jpg").read_text() == "tile"
    assert (out / "images/P_2_4.jpg").read_bytes() == png(pixels[4:14, 2:12])
    assert "\ntest: images\n" in (out / "data.yaml").read_text() and "train" not in (out / "data.yaml").read_text()
    features = json.loads((out / "testset_unlabeled_combined_footprints.geojson").read_text())["features"]
    assert len(features) == 4 and all(abs(x - w) < 1e-3 and abs(y - s) < 1e-3 for f in features for x, y in f["geometry"]["coordinates"][0])


def test_map_commands(spark, tmp_path):
    """The commands of the map tables, through main(), over a small export folder."""
    w, s = 15.0, 48.0
    split = tmp_path / "sliced_split_dataset"
    _collection(tmp_path / "sliced_dataset_edge_coordinates/image_footprints.geojson", *(_square(f"{n}_0_0.jpg", w, s + i * 1e-3, w + 1e-4, s + i * 1e-3 + 1e-4) for i, n in enumerate("TVRD")))
    _collection(tmp_path / "sliced_unlabeled/edge_coordinates/image_footprints.geojson", _square("near", w, s, w + 1e-4, s + 1e-4), _square("safe", w, s + 5e-3, w + 1e-4, s + 6e-3))
    for name, cohort in (("T", "test"), ("V", "val"), ("R", "train")):
        (split / cohort / "images").mkdir(parents=True)
        (split / cohort / f"images/{name}_0_0.jpg").write_text("x")
    (split / "dropped_images.txt").write_text("D_0_0.jpg\n")
    out = tmp_path / "maps"
    jobs.main(["maps", "--export-dir", str(tmp_path), "--output-dir", str(out)])
    read = lambda name: spark.read.parquet(str(out / name))
    assert {(r.image_name[0], r.layer) for r in read("splits_layer").collect()} == {("T", "test"), ("V", "val"), ("R", "train"), ("D", "buffer")}
    assert {(r.image_name, r.layer) for r in read("distillation").collect()} >= {("safe", "safe_unlabeled"), ("R_0_0.jpg", "labeled_train")}
    assert read("composition").count() == 4 and read("extent").first().y_max > read("extent").first().y_min + 300
    combined = tmp_path / "testset_unlabeled_combined"
    _collection(combined / "testset_unlabeled_combined_footprints.geojson", _square("T_0_0.jpg", w, s, w + 1e-4, s + 1e-4), _square("safe", w - 1e-3, s + 5e-3, w - 9e-4, s + 6e-3))
    (combined / "labels").mkdir()
    (combined / "labels/T_0_0.txt").write_text("0 0.5 0.5 0.1 0.1\n\n1 0.5 0.5 0.1 0.1\n")
    (combined / "labels/safe.txt").write_text("")
    jobs.main(["testset-map", "--export-dir", str(tmp_path), "--output-dir", str(out)])
    assert {(r.image_name, r.slice_type, r.n_boxes) for r in read("testset_points").collect()} == {("T_0_0.jpg", "labeled_test", 2), ("safe", "unlabeled_test", 0)}
    assert (read("testset_metrics").first().fg, read("testset_metrics").first().boxes) == (1, 2)
    zoom = read("testset_zoom").first()
    assert (round(zoom.x_max - zoom.x_min, 6), round(zoom.y_max - zoom.y_min, 6), zoom.n) == (130, 75, 1)


def test_campaign_choice(tmp_path):
    two = {"2023": {"xml": "a.xml", "mesh": "a.obj"}, "2024": {"xml": None, "mesh": None}}
    set_ = (config.Campaign("x", 0, "x.xml", "x.obj"),)
    assert config.chosen_campaigns((), None, two) == (config.Campaign("2023", 0, "a.xml", "a.obj"),)
    assert config.chosen_campaigns(set_, str(tmp_path / "absent.json"), two) == set_
    (tmp_path / "c.json").write_text(json.dumps({"y": {"xml_path": "y.xml", "mesh_path": "y.obj"}}))
    assert config.chosen_campaigns(set_, str(tmp_path / "c.json"), two)[0].name == "y"


def test_inputs_by_the_top_folders(tmp_path):
    import pytest

    pytest.importorskip("yaml")
    (tmp_path / "export/sliced_dataset").mkdir(parents=True)
    (tmp_path / "own").mkdir()
    (tmp_path / "c.yaml").write_text("base_export_dir: export\nraw_images_dir: photos\nslicing:\n  input_dir: missing\nstratification:\n  dataset_dir: own\n")
    found = config.load(str(tmp_path / "c.yaml"))
    assert found.slicing.input_dir == str(tmp_path / "export/sliced_dataset")  # the named folder is absent, this one is there
    assert found.stratification.dataset_dir == str(tmp_path / "own")
    assert found.testset.export_dir == str(tmp_path / "export") and found.testset.raw_images_dir == str(tmp_path / "photos")
