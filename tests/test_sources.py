"""Readers and writers of the survey's file formats."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom import config
from skyloom.sources import files, names, photos, sinks, survey, yolo

XML = """<?xml version="1.0"?><document><chunk><sensors>
<sensor id="0"><resolution width="4000" height="3000"/><calibration><f>3000</f><cx>1.5</cx><cy>-2</cy></calibration><calibration><f>1</f></calibration></sensor>
<sensor id="1"><resolution width="400" height="300"/><calibration><f>300.5</f></calibration></sensor>
<sensor id="2"><resolution width="400" height="300"/></sensor></sensors>
<components><component id="0"><transform><rotation locked="false">1 0 0 0 1 0 0 0 1</rotation><translation>9 9 9</translation><scale>1</scale></transform></component>
<component id="1"><transform><rotation>0 -1 0 1 0 0 0 0 1</rotation><translation>10 20 30</translation><scale locked="true">2</scale></transform></component>
<component id="2"><transform><rotation>1 0 0 0 1 0 0 0 1</rotation></transform></component></components>
<cameras><camera id="0" sensor_id="0" label="IMG_1.JPG"><transform>1 0 0 5 0 1 0 6 0 0 1 7 0 0 0 1</transform><reference x="1" y="2" z="3"/></camera>
<camera id="1" sensor_id="1" label="dir/img_2"><transform>1 0 0 0 0 1 0 0 0 0 1 0 0 0 0 1</transform><reference x="4" y="5"/></camera>
<camera id="2" sensor_id="9" label="lost"><transform>1 0 0 0 0 1 0 0 0 0 1 0 0 0 0 1</transform></camera>
<camera id="3" sensor_id="0" label="unaligned"/>
<camera id="4" sensor_id="1" label="img_1"><transform>2 0 0 0 0 1 0 0 0 0 1 0 0 0 0 1</transform></camera></cameras></chunk></document>"""


@pytest.fixture()
def labels(tmp_path):
    root = tmp_path / "labels"
    root.mkdir()
    (root / "empty.txt").write_bytes(b"")
    (root / "one.txt").write_text("0 0.5 0.5 0.1 0.2\n\n1\t0.1 0.2  0.3 0.4", encoding="utf-8")
    (root / "odd.name.txt").write_bytes("2 0.1 0.1 0.1 0.1 extra\n3 a b c d\n4 1 1\n\xe9 0.5 0.5 0 0.5".encode("latin-1"))
    return str(root)


def test_labels(spark, labels):
    strict = {(r.stem, r.class_id, r.xc, r.bh) for r in yolo.boxes(spark, labels).collect()}
    assert strict == {("one", "0", 0.5, 0.2), ("one", "1", 0.1, 0.4), ("odd.name", "é", 0.5, 0.5)}
    loose = {(r.stem, r.class_id) for r in yolo.boxes(spark, labels, strict=False).collect()}
    assert loose == {("one", "0"), ("one", "1"), ("odd.name", "2")}
    assert yolo.rejects(spark, labels).count() == 3
    assert {(r.stem, r.content == "") for r in files.texts(spark, labels).collect()} == {("empty", True), ("one", False), ("odd.name", False)}


def test_layouts(spark, tmp_path, labels):
    found = {(r.stem, r.split, r.n_boxes, r.is_foreground) for r in yolo.dataset(spark, str(tmp_path)).collect()}
    assert found == {("empty", "all", 0, False), ("one", "all", 2, True), ("odd.name", "all", 1, True)}
    for path in ("a/train/labels", "b/labels/val", "a/train/images"):
        (tmp_path / path).mkdir(parents=True)
    assert set(files.label_folders(spark, str(tmp_path / "a"))) == {"train"} and set(files.label_folders(spark, str(tmp_path / "b"))) == {"val"}
    (tmp_path / "p/images/test").mkdir(parents=True)
    for name in ("é x.png", "B.JPG", "c.TIF", "d.txt"):
        (tmp_path / "p/images/test" / name).write_bytes(b"x")
    assert {(r.stem, r.split) for r in files.photos(spark, str(tmp_path / "p")).collect()} == {("é x", "test"), ("B", "test")}
    assert files.listing(spark, str(tmp_path / "none")).count() == 0


def test_tasks_list_folders(spark, tmp_path):
    for path in ("a b/c%20d", "a b/e+f", "none"):
        (tmp_path / path).mkdir(parents=True)
    written = {"top.txt": b"1", "a b/x.PNG": b"", "a b/.hidden": b"12", "a b/c%20d/é 100%.jpg": b"123", "a b/e+f/no suffix": b"1234"}
    for name, data in written.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "none/lost").symlink_to(tmp_path / "nowhere")
    every = files.listing(spark, str(tmp_path), recursive=True)
    assert {(r.path, r.name, r.size) for r in every.collect()} == {(f"file:{tmp_path}/{name}", name.rsplit("/", 1)[-1], len(data)) for name, data in written.items()}
    # a task a folder: the root, 'a b', its two, and 'none'
    assert every.rdd.getNumPartitions() == 5
    assert [(r.stem, r.suffix) for r in files.listing(spark, f"file:{tmp_path}").collect()] == [("top", ".txt")]
    assert [r.name for r in files.listing(spark, f"{tmp_path}/a b/c%20d").collect()] == ["é 100%.jpg"]
    assert [r.size for r in files.listing(spark, f"{tmp_path}/a b/.hidden").collect()] == [2]
    assert files.listing(spark, f"{tmp_path}/none", recursive=True).count() == 0


def test_many_folders_share_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(names, "MAX_PARTS", 3)
    monkeypatch.setattr(names, "BATCH", 2)
    for i in range(7):
        (tmp_path / f"d{i}").mkdir()
        for j in range(i):
            (tmp_path / f"d{i}/{j}").write_bytes(b"")
    reader = names.FileNames({"path": str(tmp_path), "recursive": "true"}).reader(None)
    parts = reader.partitions()
    found = [path for part in parts for batch in reader.read(part) for path in batch.column(0).to_pylist()]
    assert len(parts) == 3 and sorted(found) == sorted(f"file:{tmp_path}/d{i}/{j}" for i in range(7) for j in range(i))


def test_label_files_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("t_0_0", 1, "1", 1 / 128, 0.5, 0.1234565, 1.0), ("t_0_0", 0, "0", 0.25, 0.5, 0.5, 1.0)], "tile string, line_no int, class_id string, xc double, yc double, bw double, bh double")
    contents = yolo.label_text(rows).union(spark.createDataFrame([("background", "")], "tile string, content string"))
    sinks.label_files(spark, contents, str(tmp_path / "out"))
    assert (tmp_path / "out/t_0_0.txt").read_text() == "0 0.250000 0.500000 0.500000 1.000000\n1 0.007812 0.500000 0.123457 1.000000".replace("0.123457", f"{0.1234565:.6f}")
    assert (tmp_path / "out/background.txt").read_bytes() == b""
    assert yolo.boxes(spark, str(tmp_path / "out")).count() == 2


def test_camera_xml(spark, tmp_path):
    path = tmp_path / "cameras.xml"
    path.write_text(XML)
    found = {r.sensor_id: (r.w, r.f, r.cx, r.cy) for r in survey.sensors(spark, str(path)).collect()}
    assert found == {"0": (4000.0, 3000.0, 1.5, -2.0), "1": (400.0, 300.5, 0.0, 0.0)}
    assert survey.component(spark, str(path)).first().component == [0, -2, 0, 10, 2, 0, 0, 20, 0, 0, 2, 30, 0, 0, 0, 1]
    cameras = {r.parent_key: (r.original_label, r.w, r.transform[0]) for r in survey.cameras(spark, str(path)).collect()}
    assert cameras == {"img_1": ("img_1", 400.0, 2.0), "img_2": ("dir/img_2", 400.0, 1.0)}
    assert {(r.label, r.x, r.z) for r in survey.references(spark, str(path)).collect()} == {("IMG_1.JPG", 1.0, 3.0), ("dir/img_2", 4.0, 0.0)}


def test_mesh(spark, tmp_path):
    path = tmp_path / "m.obj"
    path.write_text("# x\nv 0 0 0\nv 1 0 0\nv 1 1 0\nv 0 1 0\nvn 0 0 1\nf 1 2 3 4\nf 1/1/1 2//2 3/3\nv 5 5 5\nf -1 -2 -3\n")
    vertices, triangles = survey.mesh(spark, str(path))
    assert vertices.count() == 5
    rows = [((r.a.x, r.a.y), (r.b.x, r.b.y), (r.c.x, r.c.y)) for r in triangles.orderBy("face_id").collect()]
    assert rows == [((0, 0), (1, 0), (1, 1)), ((0, 0), (1, 1), (0, 1)), ((0, 0), (1, 0), (1, 1)), ((5, 5), (0, 1), (1, 1))]


def test_geojson_round_trip(spark, tmp_path):
    prints = spark.createDataFrame([("b", "Mesh Hit", "2023", [(1.0, 2.0, 9.0), (3.0, 2.0, 9.0), (3.0, 4.0, 9.0), (1.0, 4.0, 9.0)])], "image_name string, status string, campaign string, corners array<struct<lon:double,lat:double,alt:double>>")
    sinks.features(prints, str(tmp_path / "out.geojson"))
    text = (tmp_path / "out.geojson").read_text()
    feature = json.loads(text)["features"][0]
    assert feature["properties"] == {"image_name": "b", "status": "Mesh Hit", "campaign": "2023", "fill": "#92eb5f", "stroke-width": 2}
    other = {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"image_name": "p"}}
    nameless = {"type": "Feature", "geometry": feature["geometry"], "properties": {}}
    path = tmp_path / "f.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [feature, other, nameless]}, indent=1))
    rows = survey.footprints(spark, str(path)).collect()
    assert [(r.image_name, r.campaign, [tuple(p) for p in r.ring]) for r in rows] == [("b", "2023", [(1, 2), (3, 2), (3, 4), (1, 4)])]


def test_slice_metadata_round_trip(spark, tmp_path):
    tiles = spark.createDataFrame([("a_0_0", "a", "", 0, 0, 1024, 1024), ("a_819_0", "a", "val", 819, 0, 1843, 1024)], "tile string, parent_image string, split_source string, x_start int, y_start int, x_end int, y_end int")
    path = tmp_path / "slice_metadata.json"
    sinks.slice_metadata(tiles, str(path))
    back = survey.slice_metadata(spark, str(path))
    assert sorted(back.select(*tiles.columns).collect()) == sorted(tiles.collect())


def test_exports_and_reads_of_many_parts(spark, tmp_path):
    """One file from many partitions, read again by several tasks: nothing is lost or split."""
    n = 20_000
    tiles = spark.range(n).repartition(7).select(
        F.concat(F.lit("t_"), F.col("id"), F.lit("_\"é, [")).alias("tile"), F.lit("p").alias("parent_image"), F.lit("train").alias("split_source"),
        F.col("id").cast("int").alias("x_start"), F.lit(0).alias("y_start"), (F.col("id") + 9).cast("int").alias("x_end"), F.lit(9).alias("y_end"),
    )
    path = str(tmp_path / "m.json")
    sinks.slice_metadata(tiles, path)
    assert len(json.loads((tmp_path / "m.json").read_text())) == n
    corners = F.array(*(F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat"), F.lit(0.0).alias("alt")) for x, y in ((1.0, 2.0), (3.0, 2.0), (3.0, 4.0))))
    prints = spark.range(n).repartition(5).select(F.concat(F.lit("i"), F.col("id")).alias("image_name"), F.lit("Mesh Hit").alias("status"), F.lit("2023").alias("campaign"), corners.alias("corners"))
    geo = str(tmp_path / "f.geojson")
    sinks.features(prints, geo)
    named = [f["properties"]["image_name"] for f in json.loads((tmp_path / "f.geojson").read_text())["features"]]
    assert len(named) == n and named == sorted(named)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
    try:
        back, again = survey.slice_metadata(spark, path), survey.footprints(spark, geo)
        assert back.select(F.spark_partition_id()).distinct().count() > 3 and again.select(F.spark_partition_id()).distinct().count() > 3
        assert back.select(*tiles.columns).exceptAll(tiles).count() == 0 and back.count() == n
        assert [r.image_name for r in again.orderBy("ord").collect()] == named and again.where(F.size("ring") == 3).count() == n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_json_that_cannot_be_cut(spark, tmp_path):
    """Braces in names, a member order of its own, and empty collections are read as a whole."""
    at = {"parent_image": "p}", "x_start": 1, "y_start": 2, "x_end": 3, "y_end": 4, "split_source": "{"}
    (tmp_path / "m.json").write_text(json.dumps({"a}": at, "b": at}, indent=2))
    assert {(r.tile, r.parent_image, r.split_source) for r in survey.slice_metadata(spark, str(tmp_path / "m.json")).collect()} == {("a}", "p}", "{"), ("b", "p}", "{")}
    square = {"geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}, "properties": {"image_name": "x"}, "type": "Feature"}
    for name, found in (("late", [square, square | {"properties": {"image_name": "Feature"}}]), ("none", [])):
        (tmp_path / name).write_text(json.dumps({"features": found, "type": "FeatureCollection"}))
        assert sorted(r.image_name for r in survey.footprints(spark, str(tmp_path / name)).collect()) == sorted(f["properties"]["image_name"] for f in found)
    (tmp_path / "empty.json").write_text("{}")
    assert survey.slice_metadata(spark, str(tmp_path / "empty.json")).count() == 0
    assert survey.footprints(spark, str(tmp_path / "absent")).count() == 0


def test_logs_and_yaml(spark, tmp_path):
    (tmp_path / "log.txt").write_text("a.b.jpg\n\n  c \n")
    (tmp_path / "none.txt").write_text("")
    assert [r.stem for r in files.lines_of(spark, str(tmp_path / "log.txt")).collect()] == ["a.b.jpg", "c"]
    assert [r.stem for r in files.lines_of(spark, str(tmp_path / "log.txt"), as_stem=True).collect()] == ["a.b", "c"]
    assert files.lines_of(spark, str(tmp_path / "none.txt")).count() == files.lines_of(spark, str(tmp_path / "absent.txt")).count() == 0
    yaml = pytest.importorskip("yaml")
    found = yaml.safe_load(sinks.data_yaml("/d", ["A. altissima", "it's"]))
    assert found == {"path": "/d", "train": "train/images", "val": "val/images", "test": "test/images", "nc": 2, "names": ["A. altissima", "it's"]}
    sinks.write_text(spark, str(tmp_path / "data.yaml"), "x: 1\n")
    assert (tmp_path / "data.yaml").read_text() == "x: 1\n"


def test_config(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "c.yaml"
    path.write_text("slicing:\n  slice_size: 512\nstratification:\n  split_ratio: [0.8, 0.1, 0.1]\n  geojson_path: x/f.geojson\nraycasting:\n  campaigns:\n    '2024': {xml_path: b.xml, mesh_path: b.obj}\n    '2023': {xml_path: a.xml, mesh_path: a.obj}\n")
    found = config.load(str(path))
    assert found.slicing.slice_size == 512 and found.slicing.overlap_ratio == 0.2
    assert found.stratification.split_ratio == (0.8, 0.1, 0.1) and found.stratification.geojson_path == str(tmp_path / "x/f.geojson")
    assert [(c.name, c.campaign_ord) for c in found.raycasting.campaigns] == [("2024", 0), ("2023", 1)]
    assert config.load().stratification.max_oversized_pct == 600.0
    with pytest.raises(FileNotFoundError):
        config.load(str(tmp_path / "absent.yaml"))


def test_copy(spark, tmp_path):
    (tmp_path / "a").write_text("x")
    rows = spark.createDataFrame([(str(tmp_path / "a"), str(tmp_path / "d/b")), (str(tmp_path / "no"), str(tmp_path / "d/c"))], "source string, target string")
    assert {r.copied for r in sinks.copy_files(rows).where(F.col("target").endswith("b")).collect()} == {True}
    assert (tmp_path / "d/b").read_text() == "x"


def test_sizes_from_headers(spark, tmp_path):
    """Sizes without decoding equal those of decoded photos, headers longer than what is read first included."""
    jvm = spark.sparkContext._jvm
    folder = tmp_path / "photos"
    folder.mkdir()
    for i, kind in enumerate(("png", "jpg", "tiff", "gif", "bmp")):
        image = jvm.java.awt.image.BufferedImage(70 + i, 40 + 3 * i, jvm.java.awt.image.BufferedImage.TYPE_INT_RGB)
        assert jvm.javax.imageio.ImageIO.write(image, kind, jvm.java.io.File(str(folder / f"a b+{i}.{kind}")))
    jpeg = (folder / "a b+1.jpg").read_bytes()
    remark = b"\xff\xfe\xff\xff" + bytes(65533)
    (folder / "long.jpg").write_bytes(jpeg[:2] + 3 * remark + b"\xff\xff\xff\xfe\x00\x02" + jpeg[2:])
    (folder / "empty.jpg").write_bytes(b"")
    (folder / "cut.jpg").write_bytes(jpeg[:12])
    (folder / "note.txt").write_text("no photo")
    stated = {(r.parent_image, r.w, r.h) for r in photos.sizes(spark, str(folder)).collect()}
    assert stated == {(r.parent_image, r.w, r.h) for r in photos.read(spark, str(folder)).collect()}
    assert len(stated) == 6 and ("long", 71, 43) in stated
    assert photos.header_size(b"II*\0" + bytes(4)) is None and photos.header_size(b"\x89PNG\r\n\x1a\n") is None


def test_size_of_the_first_readable(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.png").write_bytes(photos.png(np.zeros((3, 5, 3), np.uint8)))
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.png").write_bytes(b"broken")
    assert photos.size_of(spark, [str(tmp_path / p) for p in ("a", "c", "b")]) == (5, 3)
    assert photos.size_of(spark, [str(tmp_path / "a"), str(tmp_path / "c")]) == (1024, 1024)
