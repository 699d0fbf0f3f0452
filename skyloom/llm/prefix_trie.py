"""Operator 12: the prefix trie of conversations.

A conversation is the sequence of its turns' fingerprints (16 bytes of role and
text). All sequences are sorted by range partitions, in which the trie follows
from the common prefixes (LCP) of neighbours: a union-find takes the edges
between neighbours in descending depth; components are raised to an edge's depth,
one node a turn, and every merge makes a branching node there.

A partition's forest lacks what its neighbours hold of the same prefixes. Such
prefixes are those of its first or last sequence, so the forest is contracted to
these two chains, and the chains of all partitions are merged by prefix: counts
add up, and what a shared node has below it is summed over its ancestors. All
other nodes are final where they were made.

Defined results: rows without a conversation id are left out. Null roles and
texts are empty. Turns of one number (null comes first) are ordered by their
fingerprints, so repeated rows are turns of their own. A conversation is one
row of 20 bytes a turn. No conversations give no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import text_of
from skyloom.session import materialize

#: What a partition tells of each node of its forest; key, path and ends are null but on the two chains.
_LOCAL = (
    "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, parent_conv_id long, "
    "key binary, parent_key binary, chars long, other_children long, other_leaves long, other_saved long, part int, ends string, path array<binary>"
)
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def fingerprint(role: Column, text: Column) -> Column:
    """16 bytes that tell turns apart."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def sequences(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as array of (print, chars)."""
    role, text = text_of(df, role_col), text_of(df, text_col)
    turn = F.struct(df[turn_col].isNotNull().alias("given"), df[turn_col].alias("turn"), fingerprint(role, text).alias("print"), F.length(text).alias("chars"))
    ordered = df.where(df[conv_col].isNotNull()).groupBy(df[conv_col].cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["print"].alias("print"), t["chars"].alias("chars"))).alias("turns"))


def with_heads(found: DataFrame, source: Column, length: Column, most: int) -> DataFrame:
    """sequences() in which the first `length` (`most` at most) turns are those of the conversation `source`, if there is one.

    Turns that the source lacks are not made up: fewer come first, or none.
    """
    heads = found.select(F.col("conv_id").alias("__source"), F.slice("turns", 1, most).alias("__head"))
    placed = found.withColumns({"__source": source, "__length": length}).join(heads, "__source", "left")
    none = F.slice("turns", 1, 0)
    first = F.when(F.col("__head").isNotNull(), F.slice("__head", F.lit(1), F.col("__length"))).otherwise(none)
    own = F.slice("turns", F.col("__length") + 1, F.greatest(F.size("turns") - F.col("__length"), F.lit(0)))
    return placed.select("conv_id", F.concat(first, own).alias("turns"))


class Forest:
    """The trie of one partition's sorted sequences."""

    def __init__(self, ids: list[int], prints: np.ndarray, chars: np.ndarray, starts: np.ndarray) -> None:
        """prints and chars of all turns, one sequence after the other; sequence i has those from starts[i] to starts[i + 1]."""
        self.ids, self.prints, self.chars, self.starts = ids, prints, chars, starts
        self.depth, self.n, self.least, self.children, self.leaves, self.saved, self.first_end, self.n_ends, self.member, self.parent, self.same = (array("q") for _ in range(11))
        depths = np.diff(starts)
        ends = [self._node(int(d), 1, ids[i], 0, 0, 0, i, 1, i) for i, d in enumerate(depths)]
        shared = [self._common(i) for i in range(1, len(ids))]
        component, top = array("q", range(len(ids))), array("q", ends)

        def find(x: int) -> int:
            while component[x] != x:
                component[x] = component[component[x]]
                x = component[x]
            return x

        for i in np.argsort(-np.array(shared, np.int64), kind="stable").tolist():
            left, right = find(i), find(i + 1)
            a, b = (self._raised(top[c], shared[i]) for c in (left, right))
            self._merge(a, b)
            component[right] = left
            top[left] = a
        self.root = self._raised(top[find(0)], 0)
        self.ends = ends

    def _node(self, depth: int, n: int, least: int, children: int, leaves: int, saved: int, first_end: int, n_ends: int, member: int) -> int:
        """leaves and saved are those below the node."""
        fields = (self.depth, self.n, self.least, self.children, self.leaves, self.saved, self.first_end, self.n_ends, self.member)
        for field, value in zip(fields, (depth, n, least, children, leaves, saved, first_end, n_ends, member), strict=True):
            field.append(value)
        self.parent.append(-1)
        self.same.append(len(self.same))
        return len(self.same) - 1

    def _common(self, i: int) -> int:
        """Turns that sequences i - 1 and i begin with alike."""
        a, b, c = self.starts[i - 1 : i + 2].tolist()
        n = min(b - a, c - b)
        differ = np.flatnonzero((self.prints[a : a + n] != self.prints[b : b + n]).any(1))
        return int(differ[0]) if len(differ) else n

    def last_chars(self, t: int) -> int:
        return int(self.chars[self.starts[self.member[t]] + self.depth[t] - 1]) if self.depth[t] else 0

    def all_leaves(self, t: int) -> int:
        return self.leaves[t] if self.children[t] else 1

    def all_saved(self, t: int) -> int:
        return self.saved[t] + (self.n[t] - 1) * self.last_chars(t)

    def _raised(self, t: int, depth: int) -> int:
        """The node above t at this depth; t and those between are complete."""
        while self.depth[t] > depth:
            self.parent[t] = self._node(self.depth[t] - 1, self.n[t], self.least[t], 1, self.all_leaves(t), self.all_saved(t), 0, 0, self.member[t])
            t = self.parent[t]
        return t

    def _merge(self, a: int, b: int) -> None:
        """b, of the same depth and next to a, becomes a; sequences that end here are neighbours."""
        if self.n_ends[b] and not self.n_ends[a]:
            self.first_end[a] = self.first_end[b]
        for field in (self.n, self.children, self.leaves, self.saved, self.n_ends):
            field[a] += field[b]
        self.least[a] = min(self.least[a], self.least[b])
        self.same[b] = a

    def find(self, t: int) -> int:
        while self.same[t] != t:
            self.same[t] = self.same[self.same[t]]
            t = self.same[t]
        return t

    def chain(self, i: int) -> list[int]:
        """The nodes of sequence i from the root down."""
        t, found = self.find(self.ends[i]), []
        while True:
            found.append(t)
            if self.parent[t] < 0:
                return found[::-1]
            t = self.find(self.parent[t])

    def keys(self, i: int) -> list[bytes]:
        """An identity for each prefix of sequence i."""
        key = hashlib.md5(b"").digest()
        found = [key]
        for p in self.prints[self.starts[i] : self.starts[i + 1]]:
            key = hashlib.md5(key + p.tobytes()).digest()
            found.append(key)
        return found

    def end_text(self, t: int) -> str:
        return ",".join(map(str, self.ids[self.first_end[t] : self.first_end[t] + self.n_ends[t]]))

    def rows(self, part: int) -> Iterator[tuple]:
        """_LOCAL of each node."""
        chains = [(self.chain(i), self.keys(i)) for i in (0, len(self.ids) - 1)]
        open_nodes: dict[int, tuple[bytes, bytes | None]] = {}
        paths: dict[int, list[bytes]] = {}
        below: dict[int, set[int]] = {}
        for nodes, keys in chains:
            for k, t in enumerate(nodes):
                open_nodes[t] = keys[k], keys[k - 1] if k else None
                if k:
                    below.setdefault(nodes[k - 1], set()).add(t)
            paths[nodes[-1]] = keys
        for t in range(len(self.same)):
            if self.same[t] != t:
                continue
            up = self.find(self.parent[t]) if self.parent[t] >= 0 else -1
            known = (self.least[t], self.depth[t], self.n[t], self.children[t], self.all_leaves(t), self.all_saved(t), hashlib.sha256(self.end_text(t).encode()).hexdigest(), self.least[up] if up >= 0 else None)
            if t not in open_nodes:
                yield (*known, None, open_nodes[up][0] if up in open_nodes else None, *(None,) * 4, part, None, None)
                continue
            own = below.get(t, ())
            others = (self.children[t] - len(own), self.leaves[t] - sum(map(self.all_leaves, own)), self.saved[t] - sum(map(self.all_saved, own)))
            yield (*known, *open_nodes[t], self.last_chars(t), *others, part, self.end_text(t) if self.n_ends[t] else None, paths.get(t))


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    schema = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in _LOCAL.split(", "))])
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    ids, prints, chars, counts = [], [], [], []
    for batch in held:
        ids += batch.column(0).to_pylist()
        raw = batch.column(1)
        counts.append(raw.value_lengths().to_numpy(zero_copy_only=False))
        flat = raw.flatten()
        prints.append(np.frombuffer(b"".join(flat.to_pylist()), np.uint64).reshape(-1, 2))
        chars.append(batch.column(2).flatten().to_numpy(zero_copy_only=False))
    starts = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)
    forest = Forest(ids, np.concatenate(prints), np.concatenate(chars), starts)
    rows: list[tuple] = []
    for row in forest.rows(TaskContext.get().partitionId()):
        rows.append(row)
        if len(rows) == 10_000:
            yield _batch(rows, schema)
            rows = []
    if rows:
        yield _batch(rows, schema)


_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "array<binary>": pa.list_(pa.binary())}


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _end_hashes(rows: DataFrame) -> DataFrame:
    """(key, ends_sha256) of rows(key, part, ends): the partitions' lists one after the other, of which a task holds one batch at a time."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        out: list[tuple[bytes, str]] = []
        for batch in batches:
            for k, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ends.encode())
                else:
                    state.update(f",{ends}".encode())
        if state:
            out.append((key, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([h for _, h in out], pa.string())], ["key", "ends_sha256"])

    return rows.repartition("key").sortWithinPartitions("key", "part").select("key", "ends").mapInArrow(hashed, "key binary, ends_sha256 string")


def trie(found: DataFrame, partitions: int | None = None) -> DataFrame:
    """The nodes of sequences(): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    prints = found.select("conv_id", F.transform("turns", lambda t: t["print"]).alias("prints"), F.transform("turns", lambda t: t["chars"].cast("long")).alias("chars"))
    # the id is part of the order, so that a conversation that repeats can fill several partitions
    order = ["prints", "conv_id"]
    kept = materialize(prints)
    dealt = kept.repartitionByRange(partitions, *order) if partitions else kept.repartitionByRange(*order)
    local = materialize(dealt.sortWithinPartitions(*order).select("conv_id", "prints", "chars").mapInArrow(_local, _LOCAL))
    shared = materialize(_shared(local))
    keys = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("__parent"))
    final = local.join(shared.select("key"), "key", "left_anti")
    # nodes under a shared one learn its smallest member; all others know their parent
    inner = final.where("parent_key is null").select(*_NODE)
    under = final.where("parent_key is not null").join(keys, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("__parent", "parent_conv_id")).select(*_NODE)
    return inner.unionByName(under).unionByName(shared.join(keys, "parent_key", "left").withColumn("parent_conv_id", F.col("__parent")).select(*_NODE))


def _shared(local: DataFrame) -> DataFrame:
    """The nodes that several partitions hold, contracted to one each: key, parent_key and _NODE without the parent.

    There are two chains a partition; sums over ancestors go along the shared part of a chain.
    """
    chains = local.where("key is not null")
    merged = chains.groupBy("key").agg(
        F.count("*").alias("parts"),
        *(F.first(c).alias(c) for c in ("depth", "parent_key", "chars")),
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "other_children", "other_leaves", "other_saved")),
    )
    nodes = materialize(merged.where("parts > 1").drop("parts"))
    keys = nodes.select("key")
    single = chains.join(keys, "key", "left_anti").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("c1"), F.sum("n_leaves").alias("l1"), F.sum("saved_tokens").alias("s1"))
    inner = nodes.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("c2"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    summed = nodes.join(single, "key", "left").join(inner, "key", "left")
    children = zero("other_children") + zero("c1") + zero("c2")
    own = materialize(
        summed.select(
            "key", "parent_key", "depth", "conv_id", "n_convs", children.alias("n_children"),
            (zero("other_leaves") + zero("l1") + F.when(children == 0, 1).otherwise(0)).alias("leaves"),
            (zero("other_saved") + zero("s1") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        )
    )
    steps = local.where("path is not null").select(F.struct("part", F.element_at("path", -1)).alias("chain"), F.posexplode("path").alias("at", "key")).join(keys, "key")
    paths = steps.groupBy("chain").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "key"))), lambda s: s["key"]).alias("keys")).select("keys").distinct()
    above = paths.select("keys", F.posexplode("keys").alias("at", "key")).select("key", F.explode(F.slice("keys", F.lit(1), F.col("at") + 1)).alias("above")).distinct()
    totals = above.join(own.select("key", "leaves", "saved"), "key").groupBy(F.col("above").alias("key")).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ends = _end_hashes(chains.where("ends is not null").join(keys, "key").select("key", "part", "ends"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return own.drop("leaves", "saved").join(totals, "key").join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
