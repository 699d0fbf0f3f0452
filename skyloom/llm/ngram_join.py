"""Operator 7: n-gram Jaccard self-join with Bayesian candidate pruning.

Documents are sets of five-word shingles. Equal texts become one row with a count
first. MinHash bands give candidates; candidates compare their MinHash values a
few at a time, and a pair is dropped as soon as the posterior probability that
its similarity reaches the threshold falls below a tolerance. The pairs that stay
tie documents into families; within a family every pair is then verified exactly
on the shingles themselves.

Large buckets and families are cut into blocks of bounded rows and bytes, and a
group is one pair of blocks, so no key brings an unbounded group into one task;
pairs are counted inside the tasks and never become rows. Members of a bucket
first meet within their block alone, which ties most copies together; then only
buckets in which several families are left are compared across blocks, and there
the members outside the largest family with all others. With 32 bands of 4 values, a
pair at the threshold of 0.8 misses all bands with probability 5e-8, and pruning
drops it with probability of the order of the tolerance.

Defined results: words are what stands between white space; a text with fewer
words than a shingle is one shingle, and a text without words (null and empty
ones too) is linked with nothing. The class of a document is the least id of its
family of links (null ids count only where there is no other); links count all
other rows that are similar enough, copies included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import small_batches, text_of
from skyloom.llm.components import components
from skyloom.session import materialize

WORDS = 5
THRESHOLD = 0.8
HASHES, BAND = 128, 4
#: Values compared at a time, and the probability below which a pair is dropped.
STRIDE = 16
TOLERANCE = 1e-7
#: Members of a block, about, and bytes of their shingle sets.
BLOCK = 256
BLOCK_BYTES = 32 << 20
#: Family members up to which their keys are broadcast (32 bytes each).
BROADCAST_ROWS = 1_000_000

_RANDOM = np.random.default_rng(11)
_A = _RANDOM.integers(1, 1 << 32, HASHES, np.uint64).astype(np.uint32) | np.uint32(1)
_B = _RANDOM.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)
_PLACE = _RANDOM.integers(1, 1 << 63, 16, np.uint64) | np.uint64(1)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The distinct 64-bit hashes of all runs of `words` words, sorted."""
    tokens = text.split()
    if not tokens:
        return np.zeros(0, np.uint64)
    # no cache of words between texts: it took 80 MB of each worker and saved no time
    known = {token: xxhash.xxh64_intdigest(token) for token in set(tokens)}
    hashed = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(hashed))
    mixed = np.full(len(hashed) - width + 1, np.uint64(width))
    for i in range(width):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _PLACE[i] + hashed[i : i + len(mixed)]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(found: np.ndarray) -> np.ndarray:
    """16 bits of each of the HASHES MinHash values."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(least, (x[i : i + 2048, None] * _A + _B).min(0), out=least)
    least ^= least >> np.uint32(15)
    return ((least * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, matches below which a pair is dropped).

    With an even prior, similarity after m matches of n is Beta(m + 1, n - m + 1);
    it reaches the threshold with the probability that a binomial of n + 1 draws
    at the threshold gives m at most.
    """
    limits = []
    for n in range(STRIDE, HASHES + 1, STRIDE):
        total, term, m = 0.0, (1 - threshold) ** (n + 1), 0
        while total + term < tolerance:
            total += term
            m += 1
            term *= (n + 2 - m) / m * threshold / (1 - threshold)
        limits.append((n, m))
    return limits


def survivors(signatures: np.ndarray, i: np.ndarray, j: np.ndarray, limits: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) that no comparison drops."""
    matches = np.zeros(len(i), np.int16)
    for n, least in limits:
        if not len(i):
            break
        matches += (signatures[i, n - STRIDE : n] == signatures[j, n - STRIDE : n]).sum(1, dtype=np.int16)
        stay = matches >= least
        i, j, matches = i[stay], j[stay], matches[stay]
    return i, j


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of about `rows` rows, or BLOCK_BYTES, that hold whole groups (column g), and the starts of their groups."""
    held: list[pa.RecordBatch] = []
    n = size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            held.append(part)
            n += part.num_rows
            size += part.nbytes
            if n < rows and size < BLOCK_BYTES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            g = table.column("g").to_numpy()
            cut = int(_starts(g)[-2])  # where the last group starts
            if cut:
                yield table.slice(0, cut).combine_chunks(), _starts(g[:cut])
                held = table.slice(cut).to_batches()
                n, size = len(g) - cut, sum(b.nbytes for b in held)
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _starts(table.column("g").to_numpy())


def _starts(g: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]])


def _pairs_of(starts: np.ndarray, block: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each group: within its block, or between its two blocks."""
    small_i = starts[:-1][np.diff(starts) == 2]
    if len(small_i):
        keep = (lo[small_i] == hi[small_i]) | (block[small_i] != block[small_i + 1])
        yield small_i[keep], small_i[keep] + 1
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b - a <= 2:
            continue
        if lo[a] == hi[a]:
            i, j = np.triu_indices(b - a, 1)
        else:
            left, right = np.flatnonzero(block[a:b] == lo[a]), np.flatnonzero(block[a:b] == hi[a])
            i, j = np.repeat(left, len(right)), np.tile(right, len(left))
        yield i + a, j + a


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n rows the first row of its component under the pairs (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _blocked(members: DataFrame, key: str, blocks: Column) -> DataFrame:
    """members with a row for each pair of blocks that they are in: block, lo, hi, g (a key of the group)."""
    dealt = members.withColumn("__blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("__blocks")).cast("int"))
    paired = dealt.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    sides = paired.withColumns({"lo": F.least("block", "__other"), "hi": F.greatest("block", "__other")}).drop("__other", "__blocks")
    return sides.withColumn("g", F.xxhash64(key, "lo", "hi"))


def _across(dealt: DataFrame, tied: DataFrame, width: int) -> DataFrame:
    """Members of buckets with several blocks and several families, by pairs of blocks: rid, root, block, lo, hi, g.

    The largest family of a bucket has blocks of its own, which are not paired with each other.
    """
    rooted = dealt.join(tied.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    families = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    open_ = families.groupBy("bucket").agg(F.sum("n").alias("m"), F.max("n").alias("most"), F.max_by("root", F.struct("n", "root")).alias("first")).where((F.col("m") > width) & (F.col("most") < F.col("m")))
    members = rooted.join(open_, "bucket")
    large, rest = F.ceil(F.col("most") / width), F.ceil((F.col("m") - F.col("most")) / width)
    own = F.col("root") == F.col("first")
    placed = members.withColumns({"__large": large.cast("int"), "__rest": rest.cast("int"), "__own": own})
    spread = F.xxhash64("rid")
    block = F.when(F.col("__own"), F.pmod(spread, F.col("__large"))).otherwise(F.col("__large") + F.pmod(spread, F.col("__rest"))).cast("int")
    first = F.when(F.col("__own"), F.col("__large")).otherwise(F.lit(0))
    paired = placed.withColumn("block", block).withColumn("__other", F.explode(F.sequence(first, F.col("__large") + F.col("__rest") - 1)))
    sides = paired.withColumns({"lo": F.least("block", "__other"), "hi": F.greatest("block", "__other")})
    return sides.select("rid", "root", "block", "lo", "hi", F.xxhash64("bucket", "lo", "hi", F.lit(1)).alias("g"))


def _families(groups: DataFrame, threshold: float, tolerance: float, width: int) -> DataFrame:
    """(node, root) of documents tied by pairs that pruning lets through. groups: rid, sig."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(HASHES // BAND, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            mixed = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + salt
            mixed = (mixed ^ (mixed >> np.uint64(28))) * np.uint64(0x94D049BB133111EB)
            yield pa.RecordBatch.from_pydict({"bucket": mixed.ravel().view(np.int64), "rid": np.repeat(batch.column("rid").to_numpy(), values.shape[1])})

    dealt = groups.select("rid", "sig").mapInArrow(bands, "bucket long, rid long")
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    # few members share a bucket: written, so that the bands are dealt once
    shared = materialize(dealt.join(sizes, "bucket"))
    limits = least_matches(threshold, tolerance)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_groups(batches, 8192):
            rid, root, block, lo, hi = (table.column(c).to_numpy() for c in ("rid", "root", "block", "lo", "hi"))
            signatures = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
            left, right = [np.zeros(0, int)], [np.zeros(0, int)]
            for i, j in _pairs_of(starts, block, lo, hi):
                apart = root[i] != root[j]
                i, j = i[apart], j[apart]
                for at in range(0, len(i), 100_000):
                    a, b = survivors(signatures, i[at : at + 100_000], j[at : at + 100_000], limits)
                    left.append(a)
                    right.append(b)
            label = _forest(len(rid), np.concatenate(left), np.concatenate(right))
            tied = np.flatnonzero(label != np.arange(len(rid)))
            ends = np.unique(np.stack([rid[label[tied]], rid[tied]], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], schema=schema)

    def met(members: DataFrame) -> DataFrame:
        """Edges between members of the same group."""
        valued = members.join(groups.select("rid", "sig"), "rid").repartition("g").sortWithinPartitions("g", "lo", "hi")
        return valued.select("g", "rid", "root", "block", "lo", "hi", "sig").mapInArrow(compare, "a long, b long")

    block = F.pmod(F.xxhash64("rid"), F.ceil(F.col("m") / width)).cast("int")
    within = shared.select("rid", F.col("rid").alias("root"), block.alias("block"), block.alias("lo"), block.alias("hi"), F.xxhash64("bucket", block).alias("g"))
    near = components(met(within))
    whole = shared.where(F.col("m") > width).select("bucket", "rid")
    if not whole.limit(1).count():
        return near
    near = materialize(near)
    # both ends of an edge stand for their families
    far = met(_across(whole, near, width))
    return components(near.select(F.col("node").alias("a"), F.col("root").alias("b")).union(far))


def _linked(rows: list[np.ndarray], pairs: Iterator[tuple[np.ndarray, np.ndarray]], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of shingle sets whose Jaccard similarity reaches the threshold, exactly."""
    sizes = np.array([len(r) for r in rows])
    found_i, found_j = [], []
    for i, j in pairs:
        near = np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j]) - 1e-9
        i, j = i[near], j[near]
        if not len(i):
            continue
        if len(i) <= 64:
            common = np.array([len(np.intersect1d(rows[a], rows[b], assume_unique=True)) for a, b in zip(i, j, strict=True)])
        else:
            used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
            common = _overlaps([rows[u] for u in used])[place[: len(i)], place[len(i) :]]
        stay = common >= threshold * (sizes[i] + sizes[j] - common) - 1e-9
        found_i.append(i[stay])
        found_j.append(j[stay])
    return np.concatenate([*found_i, np.zeros(0, int)]), np.concatenate([*found_j, np.zeros(0, int)])


def _overlaps(rows: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of slices of the incidence matrix."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.concatenate(rows)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    column = np.cumsum(np.concatenate([[0], flat[1:] != flat[:-1]]))
    shared = np.bincount(column)[column] > 1  # the others are in no intersection
    column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
    common = np.zeros((len(rows), len(rows)), np.float32)
    for first in range(0, int(column.max(initial=-1)) + 1, 4096):
        a, b = np.searchsorted(column, (first, first + 4096))
        part = np.zeros((len(rows), 4096), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        common += part @ part.T
    return common


def _verified(texts: DataFrame, threshold: float, words: int) -> DataFrame:
    """(rid, links, other, multi) from texts(rid, family, m, n, blocks, text): links of each block pair, and ties."""

    @F.arrow_udf(T.BinaryType())
    def sets(column: pa.Array) -> pa.Array:
        return pa.array([shingles(t, words).tobytes() for t in column.to_pylist()], pa.binary())

    members = texts.select("rid", "family", "m", "n", "blocks", sets("text").alias("set"))
    dealt = _blocked(members, "family", F.col("blocks")).repartition("g").sortWithinPartitions("g", "rid")
    schema = pa.schema([("rid", pa.int64()), ("links", pa.int64()), ("other", pa.int64()), ("multi", pa.bool_())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_groups(batches, 512):
            rid, block, lo, hi, n, blocks = (table.column(c).to_numpy() for c in ("rid", "block", "lo", "hi", "n", "blocks"))
            rows = [np.frombuffer(s, np.uint64) for s in table.column("set").to_pylist()]
            i, j = _linked(rows, _pairs_of(starts, block, lo, hi), threshold)
            links = np.bincount(i, n[j], len(rid)) + np.bincount(j, n[i], len(rid))
            label = _forest(len(rid), i, j)
            keep = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays([pa.array(rid[keep]), pa.array(links[keep].astype(np.int64)), pa.array(rid[label[keep]]), pa.array(blocks[keep] > 1)], schema=schema)

    return dealt.select("g", "rid", "block", "lo", "hi", "n", "blocks", "set").mapInArrow(verify, "rid long, links long, other long, multi boolean")


def text_keys(text: Column) -> dict[str, Column]:
    """Two 64-bit hashes that stand for a text."""
    return {"__k1": F.xxhash64(text), "__k2": F.xxhash64(F.lit("second"), text)}


def classify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, words: int = WORDS, tolerance: float = TOLERANCE, width: int = BLOCK) -> DataFrame:
    """One row a document: id, __k1, __k2 (its text's keys), class_id, n_links, keeper (the row that stays, one a class)."""
    small_batches(df.sparkSession)
    docs = df.select(df[id_col].alias("id"), text_of(df, text_col).alias("text"))

    @F.arrow_udf(T.BinaryType())
    def values(texts: pa.Array) -> pa.Array:
        return pa.array([signature(s).tobytes() if len(s := shingles(t, words)) else None for t in texts.to_pylist()], pa.binary())

    marked = materialize(docs.select("id", *(c.alias(k) for k, c in text_keys(F.col("text")).items()), F.octet_length("text").cast("long").alias("size"), values("text").alias("sig")))
    groups = marked.where("sig is not null").groupBy("__k1", "__k2").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.first("size").alias("size"), F.first("sig").alias("sig"))
    groups = materialize(groups.withColumn("rid", F.monotonically_increasing_id()))
    tied = _families(groups, threshold, tolerance, width)
    roots = tied.select(F.col("root").alias("node"), "root").distinct()
    families = materialize(tied.union(roots).select(F.col("node").alias("rid"), F.col("root").alias("family")))
    known = families.join(groups.select("rid", "__k1", "__k2", "n", "first", "size"), "rid")
    # a shingle set has about one and a half bytes for each of its text
    blocks = F.ceil(F.greatest(F.count("*") / width, F.sum("size") * 1.5 / BLOCK_BYTES))
    sizes = known.groupBy("family").agg(F.count("*").alias("m"), blocks.cast("int").alias("blocks"))
    need = known.drop("size").join(sizes, "family")
    need = materialize(need)
    wanted = F.broadcast(need) if need.count() <= BROADCAST_ROWS else need
    keyed = docs.select("id", "text", *(c.alias(k) for k, c in text_keys(F.col("text")).items()))
    texts = keyed.join(wanted, (keyed["__k1"] == wanted["__k1"]) & (keyed["__k2"] == wanted["__k2"]) & keyed["id"].eqNullSafe(wanted["first"]))
    # rows that repeat their id and text are one row here: their number is in n
    once = texts.select("rid", "family", "m", "n", "blocks", "text").dropDuplicates(["rid"])
    found = materialize(_verified(once, threshold, words))
    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    whole = found.where("not multi and rid <> other").select(F.col("rid").alias("node"), F.col("other").alias("root"))
    parts = components(found.where("multi and rid <> other").select(F.col("rid").alias("a"), F.col("other").alias("b")))
    root = groups.select("rid", "__k1", "__k2", "n", "first").join(whole.union(parts).withColumnRenamed("node", "rid"), "rid", "left").join(links, "rid", "left")
    root = root.select("rid", "__k1", "__k2", "first", F.coalesce("root", "rid").alias("root"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    least = root.groupBy("root").agg(F.min("first").alias("class_id"), F.min_by(F.struct("__k1", "__k2"), F.struct(F.col("first").isNull(), "first", "__k1", "__k2")).alias("keep"))
    named = root.join(least, "root").select("__k1", "__k2", "first", "class_id", "n_links", ((F.col("keep.__k1") == F.col("__k1")) & (F.col("keep.__k2") == F.col("__k2"))).alias("best"))
    out = marked.select("id", "__k1", "__k2").join(named, ["__k1", "__k2"], "left")
    alone = F.col("best").isNull()
    return out.select(
        "id",
        "__k1",
        "__k2",
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | (F.col("best") & F.col("id").eqNullSafe(F.col("first")))).alias("keeper"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each class (that with the least id), and all texts without words; columns stay.

    Rows that repeat another's id and text are one row.
    """
    keepers = classify(df, id_col, text_col, **how).where("keeper").select(F.col("id").alias("__id"), "__k1", "__k2")
    keyed = df.withColumns(text_keys(text_of(df, text_col)))
    on = (keyed["__k1"] == keepers["__k1"]) & (keyed["__k2"] == keepers["__k2"]) & keyed[id_col].eqNullSafe(keepers["__id"])
    return keyed.join(keepers, on, "left_semi").dropDuplicates(["__k1", "__k2", id_col]).drop("__k1", "__k2")
