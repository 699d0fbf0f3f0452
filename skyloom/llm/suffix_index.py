"""Operator 11: repeated passages by a logarithmic family of suffix arrays.

A passage is a string of LENGTH bytes that starts more than once, in one text or
in several. Of a text's suffixes those are indexed at which the least hash of
its PREFIX bytes stands in some window of LENGTH bytes: equal windows choose
equal places, so a repeated window meets its repeats at their chosen suffixes,
and one suffix in fifty is enough. Suffix arrays hold these, sorted by a 64-bit
fingerprint of their first PREFIX bytes (any order will do in which equal
prefixes are neighbours), in tables bucketed by it, so that joins of two of
them read sorted files and move nothing.

Texts come in batches. A batch gets its suffix array, which is merge-scanned
against each level of the family for prefixes that both hold; it then becomes a
level itself, and levels of equal size are merged, so a suffix is written a
logarithmic number of times. batches=1 is one suffix array without levels.

Long matches are verified from there. A chosen suffix decides a run of windows;
where all runs of a prefix have the same bytes, all their windows repeat. Where
they differ, the runs' bytes are fetched and compared window by window: in one
task for prefixes with up to GROUP different runs, by a shuffle of windows
beyond. Equality of bytes is that of two 64-bit fingerprints.

Defined results: null and empty texts, and those shorter than LENGTH, have no
repeats and keep their bytes. Every row counts as a text of its own, so repeated
rows repeat each other wholly, whatever their ids. Very long texts are read in
blocks of BLOCK windows. An empty table gives no rows. Other columns pass
through; those named repeats or kept are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import small_batches, text_of
from skyloom.session import hadoop_path, materialize, shared_dir

LENGTH, PREFIX = 200, 100
#: Windows that are looked at together.
BLOCK = 1 << 18
#: Different runs of one prefix that one task compares: some 15 MB of bytes and fingerprints.
GROUP = 16_384

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_OF_BYTE = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for one block."""
    if not _POWERS:
        n = BLOCK + LENGTH + 1
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            powers = np.full(n, base, np.uint64)
            powers[0] = 1
            _POWERS[i] = np.multiply.accumulate(powers)
    return _POWERS[0], _POWERS[1]


def _mixed(x: np.ndarray, by: int) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(by)
    return x ^ (x >> _U(29))


def run_marks(keys: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """One number for a run: its prefix and its bytes."""
    return _mixed(keys + contexts * _U(0xD6E8FEB86659FD93), 0xFF51AFD7ED558CCD)


def window_marks(windows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One number for a window in a run of this prefix."""
    return _mixed(windows ^ (keys * _U(0xC4CEB9FE1A85EC53)), 0x9FB21C651E98DF25)


class Runs:
    """Runs of windows of one block of a text: each has a chosen suffix, the first `PREFIX` bytes of which are its key."""

    def __init__(self, data: np.ndarray) -> None:
        up, down = _powers()
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_OF_BYTE[data] * up[:n], out=sums[1:])
        grams = _mixed((sums[PREFIX:] - sums[:-PREFIX]) * down[: n - PREFIX + 1], 0x87C37B91114253D5)
        least, at, width = grams, np.arange(len(grams), dtype=np.int32), 1
        wanted = LENGTH - PREFIX + 1
        while width < wanted:  # the first least of `width` grams from each place on
            step = min(width, wanted - width)
            later = least[step:] < least[:-step]
            least, at = np.where(later, least[step:], least[:-step]), np.where(later, at[step:], at[:-step])
            width += step
        self.starts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        self.ends = np.concatenate([self.starts[1:], [len(at)]])
        self.keys = grams[at[self.starts]]
        self.contexts = _mixed((sums[self.ends + LENGTH - 1] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64), 0x4CF5AD432745937F)
        self._sums, self._down = sums, down

    def windows(self) -> np.ndarray:
        """Fingerprints of all windows, in order."""
        n = self.ends[-1]
        return _mixed((self._sums[LENGTH:] - self._sums[:-LENGTH]) * self._down[:n], 0x2127599BF4325C37)

    def spread(self, of_runs: np.ndarray) -> np.ndarray:
        """A value of each run for each of its windows."""
        return np.repeat(of_runs, self.ends - self.starts)


def blocks(text: bytes) -> Iterator[tuple[int, Runs]]:
    """The runs of a text, with the byte at which each block of them begins."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data) - LENGTH + 1, BLOCK):
        yield at, Runs(data[at : at + BLOCK + LENGTH - 1])


def _texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(offsets, pa.array(flat, kind))


def suffixes(texts: DataFrame) -> DataFrame:
    """(h, keys, contexts, twice) of texts(h, text): the distinct runs of each text, and whether it has them more than once."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list[np.ndarray]] = [[], [], []]
            for text in _texts(batch.column(1)):
                parts = [(r.keys, r.contexts) for _, r in blocks(text)]
                keys, contexts = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64),) * 2
                _, first, counts = np.unique(run_marks(keys, contexts), return_index=True, return_counts=True)
                for row, values in zip(rows, (keys[first].view(np.int64), contexts[first].view(np.int64), counts > 1), strict=True):
                    row.append(values)
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(rows[0], pa.int64()), _lists(rows[1], pa.int64()), _lists(rows[2], pa.bool_())], ["h", "keys", "contexts", "twice"])

    return texts.mapInArrow(found, "h long, keys array<long>, contexts array<long>, twice array<boolean>")


class Family:
    """Suffix arrays in levels of geometric size. Rows are (key, low, high, many): a prefix, the extremes of its runs, and whether it starts more than once."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[tuple[int, str, str]] = []

    def _written(self, rows: DataFrame) -> tuple[str, str]:
        name = f"skyloom_{uuid.uuid4().hex}"
        path = f"{shared_dir(self.spark)}/{name}"
        rows.write.bucketBy(self.buckets, "key").sortBy("key").option("path", path).saveAsTable(name)
        return name, path

    def _dropped(self, name: str, path: str) -> None:
        self.spark.sql(f"drop table if exists {name}")
        where, system = hadoop_path(self.spark, path)
        system.delete(where, True)

    def add(self, batch: DataFrame) -> DataFrame:
        """Index a batch; returns (key, low, high) of prefixes that it repeats, within itself or from a level."""
        name, path = self._written(batch)
        array = self.spark.table(name)
        hits = array.where("many").select("key", "low", "high")
        for _, level, _ in self.levels:
            hits = hits.unionByName(self._scan(array, self.spark.table(level)))
        hits = materialize(hits)
        self.levels.append((1, name, path))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, one, one_path), (_, two, two_path) = self.levels[-2:]
            merged = self._written(self._merged(self.spark.table(one), self.spark.table(two)))
            self.levels[-2:] = [(2 * size, *merged)]
            self._dropped(one, one_path)
            self._dropped(two, two_path)
        return hits

    @staticmethod
    def _scan(one: DataFrame, two: DataFrame) -> DataFrame:
        both = one.alias("a").join(two.alias("b"), "key")
        return both.select("key", F.least("a.low", "b.low").alias("low"), F.greatest("a.high", "b.high").alias("high"))

    @staticmethod
    def _merged(one: DataFrame, two: DataFrame) -> DataFrame:
        both = one.alias("a").join(two.alias("b"), "key", "full")
        twice = F.col("a.low").isNotNull() & F.col("b.low").isNotNull()
        many = F.coalesce("a.many", F.lit(False)) | F.coalesce("b.many", F.lit(False)) | twice
        return both.select("key", F.least("a.low", "b.low").alias("low"), F.greatest("a.high", "b.high").alias("high"), many.alias("many"))

    def close(self) -> None:
        for _, name, path in self.levels:
            self._dropped(name, path)
        self.levels = []


def _exploded(entries: DataFrame) -> DataFrame:
    """(h, key, context, times): a row for each run of a text."""
    zipped = entries.select("h", F.inline(F.arrays_zip("keys", "contexts", "twice")).alias("key", "context", "twice"))
    return zipped.select("h", "key", "context", F.when(F.col("twice"), 2).otherwise(1).alias("times"))


def suffix_array(entries: DataFrame) -> DataFrame:
    """The suffix array of a batch of suffixes()."""
    runs = _exploded(entries)
    return runs.groupBy("key").agg(F.min("context").alias("low"), F.max("context").alias("high"), (F.sum("times") > 1).alias("many"))


def _repeated(entries: DataFrame, batches: int) -> DataFrame:
    """(key, alike): prefixes that start more than once, and whether all their runs are."""
    family = Family(entries.sparkSession)
    hits: DataFrame | None = None
    try:
        for i in range(batches):
            found = family.add(suffix_array(entries.where(F.pmod("h", F.lit(batches)) == i)))
            hits = found if hits is None else hits.unionByName(found)
        assert hits is not None
        return materialize(hits.groupBy("key").agg((F.min("low") == F.max("high")).alias("alike")))
    finally:
        family.close()


def _context_bytes(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, key, context, alone, hot, bytes) for each of wanted(h, runs) from texts(h, text)."""
    schema = "h long, key long, context long, alone boolean, hot boolean, bytes binary"

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for h, text, runs in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                left = {(r["key"], r["context"]): r for r in runs}
                for at, r in blocks(text):
                    for i, run in enumerate(zip(r.keys.view(np.int64).tolist(), r.contexts.view(np.int64).tolist(), strict=True)):
                        if asked := left.pop(run, None):
                            out.append((h, *run, asked["alone"], asked["hot"], text[at + int(r.starts[i]) : at + int(r.ends[i]) + LENGTH - 1]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
            columns = zip(*out, strict=True) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["h", "key", "context", "alone", "hot", "bytes"])

    return texts.join(wanted, "h").select("h", "text", "runs").mapInArrow(found, schema)


def _windows_of(run: bytes) -> np.ndarray:
    """Fingerprints of the windows of a run."""
    up, down = _powers()
    data = np.frombuffer(run, np.uint8)
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_OF_BYTE[data] * up[:n], out=sums[1:])
    return _mixed((sums[LENGTH:] - sums[:-LENGTH]) * down[: n - LENGTH + 1], 0x2127599BF4325C37)


def _compared(runs: DataFrame) -> DataFrame:
    """(h, mark) of repeated windows in runs that are alone, where all runs of a prefix fit one task."""

    def marks(keys: list[int], hs: list[int], alone: list[bool], contents: list[bytes]) -> tuple[list[np.ndarray], list[int]]:
        windows = [_windows_of(c) for c in contents]
        flat = np.concatenate(windows)
        owner = np.repeat(np.arange(len(windows)), [len(w) for w in windows])
        _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
        kept = (counts[inverse] > 1) & np.array(alone)[owner]
        key = np.full(int(kept.sum()), np.int64(keys[0])).view(np.uint64)
        return window_marks(flat[kept], key).view(np.int64), np.array(hs, np.int64)[owner[kept]]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            out: list[tuple[np.ndarray, np.ndarray]] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    out.append(marks(*zip(*held, strict=True)))
                    held = []
                held.append(row)
            yield _pairs(out)
        if held:
            yield _pairs([marks(*zip(*held, strict=True))])

    dealt = runs.select("key", "h", "alone", "bytes").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(found, "h long, mark long")


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    none = np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *(h for _, h in found)])), pa.array(np.concatenate([none, *(m for m, _ in found)]))], ["h", "mark"])


def _shuffled(runs: DataFrame) -> DataFrame:
    """_compared() where a prefix has too many runs for one task: windows meet by their fingerprints."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs, keys, contexts, alone, contents = (c.to_pylist() for c in batch.columns)
            windows = [_windows_of(c) for c in contents]
            sizes = [len(w) for w in windows]
            key = np.repeat(np.array(keys, np.int64), sizes)
            flat = np.concatenate(windows) if windows else np.zeros(0, np.uint64)
            mark = window_marks(flat, key.view(np.uint64)).view(np.int64)
            columns = [np.repeat(np.array(hs, np.int64), sizes), key, np.repeat(np.array(contexts, np.int64), sizes), mark]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(np.repeat(np.array(alone, bool), sizes))], ["h", "key", "context", "mark", "alone"])

    windows = runs.select("h", "key", "context", "alone", "bytes").mapInArrow(found, "h long, key long, context long, mark long, alone boolean")
    often = materialize(windows.groupBy("mark", "key").agg(F.min("context").alias("low"), F.max("context").alias("high")).where("low <> high").select("mark", "key"))
    return windows.where("alone").join(often, ["mark", "key"], "left_semi").select("h", "mark")


def marks(texts: DataFrame, batches: int) -> DataFrame:
    """(h, marks): what repeats in each of texts(h, text), as run_marks() and window_marks()."""
    entries = materialize(suffixes(texts))
    repeated = _repeated(entries, batches)
    found = materialize(_exploded(entries).join(repeated, "key"))
    runs = found.where("not alike").groupBy("key", "context").agg(F.sum("times").alias("times"), F.min("h").alias("h"))
    runs = materialize(runs)
    # a run of several texts repeats as a whole; others are compared with all runs of their prefix
    whole = found.where("alike").select("h", "key", "context").unionByName(
        found.where("not alike").select("h", "key", "context").join(runs.where("times > 1").select("key", "context"), ["key", "context"])
    )
    sizes = materialize(runs.groupBy("key").agg((F.count("*") > GROUP).alias("hot")))
    asked = runs.join(sizes, "key").select("h", F.struct("key", "context", (F.col("times") == 1).alias("alone"), "hot").alias("run"))
    wanted = materialize(asked.groupBy("h").agg(F.collect_list("run").alias("runs")))
    ragged = materialize(_context_bytes(texts, wanted))
    in_task = _compared(ragged.where("not hot").dropDuplicates(["key", "context"]))
    listed = _marked(whole).unionByName(in_task).unionByName(_shuffled(ragged.where("hot")))
    return materialize(listed.groupBy("h").agg(F.collect_set("mark").alias("marks")))


def _marked(runs: DataFrame) -> DataFrame:
    """(h, mark) of runs(h, key, context)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, contexts = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(run_marks(keys, contexts).view(np.int64))], ["h", "mark"])

    return runs.mapInArrow(found, "h long, mark long")


def covered(text: bytes, known: np.ndarray) -> np.ndarray:
    """Maximal spans (start, end) of a text that repeated windows cover; known are its marks, sorted."""
    starts = []
    for at, runs in blocks(text):
        hit = runs.spread(_among(run_marks(runs.keys, runs.contexts), known))
        rest = np.flatnonzero(~hit)
        if len(rest):
            hit[rest] = _among(window_marks(runs.windows()[rest], runs.spread(runs.keys)[rest]), known)
        starts.append(np.flatnonzero(hit) + at)
    where = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    if not len(where):
        return np.zeros((0, 2), np.int64)
    gap = np.flatnonzero(np.diff(where) > LENGTH)
    return np.stack([where[np.concatenate([[0], gap + 1])], where[np.concatenate([gap, [len(where) - 1]])] + LENGTH], 1)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    place = np.searchsorted(known, values)
    return known[np.minimum(place, len(known) - 1)] == values


def without_repeats(df: DataFrame, text_col: str = "text", batches: int = 4) -> DataFrame:
    """df with repeats, an array of (start, end) in bytes, end exclusive, and kept, the bytes outside them."""
    small_batches(df.sparkSession)
    columns = [c for c in df.columns if c.lower() not in ("repeats", "kept")]
    rows = df.select(F.struct(*columns).alias("row"), text_of(df, text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    found = marks(rows.select("h", "text"), batches)
    joined = rows.join(found, "h", "left").select("row", "text", "marks")
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept = [], []
            for text, known in zip(_texts(batch.column(1)), batch.column(2), strict=True):
                if not known.is_valid:
                    spans.append([])
                    kept.append(text)
                    continue
                where = covered(text, np.sort(known.values.to_numpy(zero_copy_only=False).view(np.uint64)))
                spans.append([{"start": s, "end": e} for s, e in where.tolist()])
                cuts = [0, *where.ravel().tolist(), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())], ["row", "repeats", "kept"])

    schema = T.StructType([joined.schema["row"]]).add("repeats", T.ArrayType(T.StructType().add("start", "long").add("end", "long"))).add("kept", "binary")
    return joined.mapInArrow(cut, schema).select("row.*", "repeats", "kept")
