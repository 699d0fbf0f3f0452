"""Compare a Spark query with its DuckDB SQL, as the driver does."""

from __future__ import annotations

import math
from collections.abc import Iterable
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str, names: Iterable[str] = TABLES) -> duckdb.DuckDBPyConnection:
    found = duckdb.connect()
    for name in names:
        path = Path(sf_dir, f"{name}.parquet")
        found.execute(f"create view {name} as select * from '{path if path.is_file() else f'{path}/*.parquet'}'")
    return found


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows(columns: list[str], found: list[tuple]) -> list[tuple]:
    """Rows with their columns by name, in any order."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(r[i]) for i in order) for r in found), key=repr)


def assert_equal(frame, sql: str, sf_dir: str, names: Iterable[str] = TABLES) -> int:
    relation = connection(sf_dir, names).execute(sql)
    columns = [d[0] for d in relation.description]
    expected = rows(columns, relation.fetchall())
    assert sorted(columns) == sorted(frame.columns)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert len(got) == len(expected), (len(got), len(expected))
    for a, b in zip(got, expected, strict=True):
        assert a == b, (a, b)
    return len(got)
