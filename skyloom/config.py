"""Typed settings of the five stages, from YAML."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class Slicing:
    input_dir: str = "sliced_dataset"
    output_dir: str = "sliced_dataset"
    slice_size: int = 1024
    overlap_ratio: float = 0.2
    min_area_ratio: float = 0.2
    classes: tuple[str, ...] = ("A. altissima",)
    background_probabilities: dict[str, float] = field(default_factory=lambda: {"train": 0.10, "val": 1.0, "test": 1.0})


@dataclass(frozen=True)
class Campaign:
    name: str
    campaign_ord: int
    xml_path: str
    mesh_path: str


@dataclass(frozen=True)
class Raycasting:
    metadata_path: str = "slice_metadata.json"
    export_dir: str = "edge_coordinates"
    utm_epsg: int = 32633
    campaigns: tuple[Campaign, ...] = ()


@dataclass(frozen=True)
class Stratification:
    dataset_dir: str = "sliced_dataset"
    output_dir: str = "sliced_split_dataset"
    geojson_path: str = "image_footprints.geojson"
    split_ratio: tuple[float, float, float] = (0.86, 0.07, 0.07)
    max_overlap_pct: float = 0.0
    max_oversized_pct: float = 600.0
    classes: tuple[str, ...] = ("A. altissima",)
    utm_epsg: int = 32633


@dataclass(frozen=True)
class Curation:
    folder_path: str = "sliced_split_dataset"
    geojson_path: str = "image_footprints.geojson"
    dataset_name: str = "yolo_dataset"
    show_grid: bool = False
    show_orphans: bool = True


@dataclass(frozen=True)
class TestSet:
    __test__ = False

    export_dir: str = "."
    raw_images_dir: str = "raw"
    output_dir: str = "testset_unlabeled_combined"
    utm_epsg: int = 32633


@dataclass(frozen=True)
class Config:
    base: str = "."
    slicing: Slicing = field(default_factory=Slicing)
    raycasting: Raycasting = field(default_factory=Raycasting)
    stratification: Stratification = field(default_factory=Stratification)
    curation: Curation = field(default_factory=Curation)
    testset: TestSet = field(default_factory=TestSet)


def campaigns_of(found: dict[str, dict[str, str]]) -> tuple[Campaign, ...]:
    """In the order written: the first that sees a tile wins."""
    return tuple(Campaign(str(name), i, str(c["xml_path"]), str(c["mesh_path"])) for i, (name, c) in enumerate(found.items()))


def load_campaigns(path: str) -> tuple[Campaign, ...]:
    """From a JSON object of name to xml_path and mesh_path."""
    return campaigns_of(json.loads(Path(path).read_text(encoding="utf-8")))


def chosen_campaigns(given: tuple[Campaign, ...], path: str | None, two: dict[str, dict[str, str | None]]) -> tuple[Campaign, ...]:
    """Those of a JSON file that exists, else those of the settings, else the two that are named by their xml and mesh."""
    if path and Path(path).exists():
        return load_campaigns(path)
    if given:
        return given
    named = {year: {"xml_path": c["xml"], "mesh_path": c["mesh"]} for year, c in two.items() if c["xml"] and c["mesh"]}
    if not named:
        raise ValueError("no campaigns: name a file, settings, or --xml-2023 and --mesh-2023 or those of 2024")
    return campaigns_of(named)


#: Settings that name what a stage reads, and where that stands below base_export_dir.
_INPUTS = {
    ("slicing", "input_dir"): "sliced_dataset",
    ("raycasting", "metadata_path"): "sliced_dataset/slice_metadata.json",
    ("stratification", "dataset_dir"): "sliced_dataset",
    ("stratification", "geojson_path"): "sliced_dataset_edge_coordinates/image_footprints.geojson",
    ("fiftyone", "folder_path"): "sliced_split_dataset",
    ("fiftyone", "geojson_path"): "sliced_dataset_edge_coordinates/image_footprints.geojson",
    ("testset_builder", "export_dir"): "",
}


def load(path: str | None = None) -> Config:
    """Defaults, overlaid by a YAML file; a named file must exist, unknown keys are errors.

    Relative paths are taken from the file's folder. base_export_dir and raw_images_dir
    at the top say where inputs stand that a section leaves out; an input that does
    not exist gives way to that place if it does.
    """
    if path is None:
        return Config()
    import yaml

    base = Path(path).resolve().parent
    raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}

    tops = {k: base / raw[k] for k in ("base_export_dir", "raw_images_dir") if raw.get(k)}

    def place(name: str, key: str) -> Path | None:
        """Where an input stands by the settings at the top."""
        if (name, key) == ("testset_builder", "raw_images_dir"):
            return tops.get("raw_images_dir")
        return tops["base_export_dir"] / _INPUTS[name, key] if "base_export_dir" in tops and (name, key) in _INPUTS else None

    def section(kind: type, name: str):
        given = dict(raw.get(name) or {})
        for key in [k for n, k in _INPUTS if n == name] + ["raw_images_dir"] * (name == "testset_builder"):
            default = place(name, key)
            if default and (not given.get(key) or not (base / given[key]).exists() and default.exists()):
                given[key] = str(default)
        given.pop("plots_dir", None)
        given.pop("max_workers", None)
        for key, value in given.items():
            if isinstance(value, list):
                given[key] = tuple(value)
            elif isinstance(value, str) and key.endswith(("_dir", "_path")):
                given[key] = str(base / value)
        if "campaigns" in given:
            given["campaigns"] = campaigns_of({n: {k: str(base / p) for k, p in c.items()} for n, c in given["campaigns"].items()})
        return kind(**given)

    return Config(
        base=str(base),
        slicing=section(Slicing, "slicing"),
        raycasting=section(Raycasting, "raycasting"),
        stratification=section(Stratification, "stratification"),
        curation=section(Curation, "fiftyone"),
        testset=section(TestSet, "testset_builder"),
    )
