"""Operator 12 against a trie of dictionaries, over one partition and over many."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skyloom.llm import prefix_trie
from skyloom.llm.queries import QUERIES
from skyloom.session import table

SCHEMA = "conv_id long, turn long, role string, text string"


def _ordered(rows) -> dict[int, list[tuple[str, str]]]:
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns, key=lambda x: x[:2])] for c, turns in found.items()}


def _rebuilt(found):
    out = {}
    for c, turns in found.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = found.get(c - c % 100, [])[:h] + turns[h:]
    return out


def _brute(found) -> list[tuple]:
    members = defaultdict(list)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = sum(saved[c] for c in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    rows = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(found[c]) == len(node))
        up = min(members[node[:-1]]) if node else None
        rows.append((min(ids), len(node), up, len(ids), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def _rows(frame):
    return sorted((tuple(r) for r in frame.select(*prefix_trie._NODE).collect()), key=repr)


def test_query_is_brute_force(spark, sf_dir):
    given = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert _rows(QUERIES["op12_prefix_trie"](spark, sf_dir)) == _brute(_rebuilt(_ordered(given)))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("partitions", [1, 3, 12])
def test_random_tries(spark, seed, partitions):
    """Few different turns, so that nodes reach over many partitions, and many equal conversations."""
    rng = random.Random(seed)
    rows = []
    for conv in range(rng.choice([1, 5, 60])):
        for turn in range(rng.choice([1, 2, 3, 5])):
            rows.append((conv * 7, turn, rng.choice("ua"), rng.choice(["", "x", "yy"]) if rng.random() < 0.7 else "same text"))
    rows += [(1000 + i, 0, "u", "hot") for i in range(25)] + [(2000 + i, t, "u", "hot") for i in range(5) for t in range(3)]
    found = prefix_trie.sequences(spark.createDataFrame(rows, SCHEMA))
    assert _rows(prefix_trie.trie(found, partitions)) == _brute(_ordered(rows))


def test_odd_rows(spark, tmp_path):
    """Null ids, turns, roles and texts, ties, repeats, absent roots, turnless and very long conversations."""
    rows = [(None, 0, "u", "lost"), (-103, 1, "u", "minus"), (5, None, None, None), (5, 0, "a", "x"), (5, 1, "a", "x"), (6, 2, "u", "b"), (6, 2, "u", "b"), (0, 0, "u", "r"), (0, None, "u", "first"), (7, 0, "u", "z")]
    rows += [(200 + i % 3, i, "u", "w" * 5) for i in range(3000)] + [(250, 0, "u", "long " * 200_000), (340, 0, "a", "no root")]
    frame = spark.createDataFrame([(*r, "n", 1, "k", 2) for r in rows], f"{SCHEMA}, print string, depth int, key string, turns int")
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    # remainders have the sign of the id, as in SQL
    found = _ordered(rows)
    rebuilt = {}
    for c, turns in found.items():
        h = zlib.crc32(str(c).encode()) % 6
        root = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = found.get(root, [])[:h] + turns[h:]
    assert any(not turns for turns in rebuilt.values())
    assert _rows(QUERIES["op12_prefix_trie"](spark, str(tmp_path))) == _brute(rebuilt)


def test_no_rows(spark):
    assert prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame([], SCHEMA))).collect() == []
    assert prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA))).collect() == []


def test_heads_of_absent_sources(spark):
    found = prefix_trie.sequences(spark.createDataFrame([(1, t, "u", str(t)) for t in range(4)], SCHEMA))
    rebuilt = prefix_trie.with_heads(found, F.lit(99), F.lit(2), 5).first()
    assert len(rebuilt.turns) == 2
