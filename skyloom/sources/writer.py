"""A data source that writes one small file a row."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class Written(WriterCommitMessage):
    files: int


class LabelWriter(DataSource):
    """format("label_files"): rows (tile, content as text or bytes) to <path>/<tile><suffix> in a folder that all executors mount."""

    @classmethod
    def name(cls) -> str:
        return "label_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], self.options.get("suffix", ".txt"))


class _Writer(DataSourceWriter):
    def __init__(self, path: str, suffix: str):
        self.suffix = suffix
        self.path = path.removeprefix("file://").removeprefix("file:")

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        os.makedirs(self.path, exist_ok=True)
        n = 0
        for row in iterator:
            # a file appears whole or not at all, however often its task runs
            target = os.path.join(self.path, f"{row.tile}{self.suffix}")
            with open(f"{target}.{os.getpid()}.part", "wb") as out:
                out.write(row.content if isinstance(row.content, bytes | bytearray) else (row.content or "").encode())
            os.replace(f"{target}.{os.getpid()}.part", target)
            n += 1
        return Written(n)
