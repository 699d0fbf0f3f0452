"""A data source of file names: a task lists a folder, so the driver sees folders only."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Tasks at most; with more folders each task lists several.
MAX_PARTS = 10_000
#: Names in an Arrow batch.
BATCH = 10_000


@dataclass
class Folders(InputPartition):
    paths: list[str]


class FileNames(DataSource):
    """format("file_names"): (path, size) of the files in a folder that driver and executors mount, and below it with recursive.

    Empty and hidden files are among them; links are followed, and those that lead
    nowhere left out.
    """

    @classmethod
    def name(cls) -> str:
        return "file_names"

    def schema(self) -> str:
        return "path string, size long"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("recursive", "false") == "true")


class _Reader(DataSourceReader):
    def __init__(self, path: str, recursive: bool):
        self.path, self.recursive = path, recursive

    def partitions(self) -> list[Folders]:
        folders = [self.path]
        if self.recursive:
            for folder in folders:  # grows on the way
                if os.path.isdir(folder):
                    with os.scandir(folder) as entries:
                        folders += sorted(e.path for e in entries if e.is_dir())
        parts = min(len(folders), MAX_PARTS)
        return [Folders(folders[i::parts]) for i in range(parts)]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, int]] = []
        for folder in partition.paths:
            for row in _files(folder):
                rows.append(row)
                if len(rows) == BATCH:
                    yield _batch(rows)
                    rows = []
        yield _batch(rows)


def _files(folder: str) -> Iterator[tuple[str, int]]:
    if os.path.isfile(folder):
        yield folder, os.path.getsize(folder)
        return
    with os.scandir(folder) as entries:
        for entry in entries:
            if entry.is_file():
                yield entry.path, entry.stat().st_size


def _batch(rows: list[tuple[str, int]]) -> pa.RecordBatch:
    # written as Hadoop writes local paths
    paths = pa.array([f"file:{os.fsencode(path).decode('utf-8', 'replace')}" for path, _ in rows], pa.string())
    return pa.RecordBatch.from_arrays([paths, pa.array([size for _, size in rows], pa.int64())], ["path", "size"])
