"""Operator 4: quartile bucket digests of whole texts.

The digest counts hashed byte triplets (taken from sliding windows of five
bytes) in 128 buckets, notes in which quarter of the counts each bucket lies,
and adds the length on a log scale, the ratios of the quartiles and a checksum.
Two digests differ by the steps between bucket quarters plus capped header
terms; likeness is 1 minus that score over its bound.

Defined results: a null or empty text, or one under five bytes, has the digest
of no triplets (all buckets in the first quarter); equal texts have equal
digests and likeness 1.
"""

from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import small_batches
from skyloom.session import materialize


BUCKETS = 128
#: Rows of a neighbour bucket, about; each is sorted within one task.
ROWS_A_BUCKET = 2_000
#: Buckets at most, so that their bounds stay small.
MAX_BUCKETS = 20_000
#: First characters of a text by which the rows of a heavy id are dealt; they bound no text.
HEAD = 256
#: Copies of one row that a task makes at a time.
COPIES = 1_000
#: Offsets in a window of five bytes, and a salt for each.
_TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
_STEP_COST = np.array([0, 1, 2, 6])
_HEADER_CAP = 12
_BOUND = BUCKETS * 6 + 4 * _HEADER_CAP

_MIX = np.array([[(v * m + (v >> 3) * 40503) & 0xFFFF for v in range(256)] for m in (40503, 60493, 26699)], np.uint16)


def digest(data: bytes) -> str:
    """70 hex digits: checksum, log length, two quartile ratios, bucket quarters."""
    b = np.frombuffer(data, np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    n = len(b) - 4
    if n > 0:
        first, second, third = _MIX[0][b], _MIX[1][b], _MIX[2][b]
        for salt, (i, j, k) in enumerate(_TRIPLETS):
            mixed = (first[i : i + n] + second[j : j + n]) ^ third[k : k + n]
            mixed *= np.uint16(40503 + 2 * salt)
            counts += np.bincount(mixed >> 9, minlength=BUCKETS)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    quarter = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    body = (quarter << np.array([6, 4, 2, 0], np.uint8)).sum(1).astype(np.uint8).tobytes()
    check = int((b.astype(np.uint32) * np.uint32(31)).sum() & 0xFF)
    ratios = (int(q1 * 16 // max(q3, 1)) % 16 << 4) | int(q2 * 16 // max(q3, 1)) % 16
    length = min(255, int(math.log2(len(b) + 1) * 8))
    return (bytes((check, length, ratios)) + body).hex()


def difference(a: str, b: str) -> int:
    """0 for equal digests, at most _BOUND."""
    if a == b:
        return 0
    x, y = np.frombuffer(bytes.fromhex(a), np.uint8), np.frombuffer(bytes.fromhex(b), np.uint8)
    shifts = np.array([6, 4, 2, 0], np.uint8)
    p, q = (x[3:, None] >> shifts & 3).astype(int), (y[3:, None] >> shifts & 3).astype(int)
    steps = int(_STEP_COST[np.abs(p - q)].sum())
    header = (int(x[0] != y[0]), abs(int(x[1]) - int(y[1])), abs(int(x[2] >> 4) - int(y[2] >> 4)), abs(int(x[2] & 15) - int(y[2] & 15)))
    return steps + sum(min(_HEADER_CAP, h) for h in header)


def likeness(a: str, b: str) -> float:
    return 1.0 - difference(a, b) / _BOUND


def edited(text: str, following: str) -> str:
    """The last half of text (rounded down) replaced by as many first characters of following."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """Add the digest of each text; other columns pass through."""
    small_batches(df.sparkSession)

    @F.arrow_udf("string")
    def digests(texts: pa.Array) -> pa.Array:
        return pa.array([digest((t or "").encode()) for t in texts.to_pylist()], pa.string())

    return df.withColumn(out_col, digests(F.col(text_col)))


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_a_bucket: int = ROWS_A_BUCKET) -> DataFrame:
    """Per row the digest of its text, of its edited text, and the next row's likeness.

    The next row is that with the next lower id (equal ids: the next greater
    text; null ids: last); after the last comes the first. Rows are dealt to
    buckets of neighbouring ids by bounds from one pass over the ids, each
    bucket also gets the first row of the bucket that follows, and a task walks
    its sorted buckets with two rows in memory: one shuffle of the texts,
    nothing whole in any task.

    An id that would fill more than one bucket (heavy: null ids, say) has its equal
    rows counted first, and its different texts dealt by bounds on their first
    HEAD characters; the copies are made afterwards, COPIES a task at a time.

    Returns id, n_chars, fingerprint, edited_text, edited_fingerprint,
    near_edited, near_next.
    """
    spark = df.sparkSession
    small_batches(spark)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # null ids are last in descending order, as the lowest
    rows = rows.select(F.coalesce("id", F.lit(-(1 << 63))).alias("key"), "id", "text")
    ids = rows.select("key")
    n = ids.count()
    buckets = max(1, min(MAX_BUCKETS, n // rows_a_bucket))
    cuts: list[int] = []
    heavy: list[int] = []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        cuts = sorted(set(ids.agg(F.percentile_approx("key", shares, 20 * buckets).alias("c")).first().c))
        if len(cuts) < buckets - 1:  # some id stands at several cuts; fewer than buckets + 1 ids
            heavy = sorted(r.key for r in ids.groupBy("key").count().where(F.col("count") > n // buckets).collect())
    head = F.substring("text", 1, HEAD)
    lowest: dict[int, str] = {}
    splits: dict[int, list[str]] = {}
    folded = None
    if heavy:
        folded = materialize(rows.where(F.col("key").isin(heavy)).groupBy("key", "id", "text").agg(F.count("*").alias("n")))
        lowest = {r.key: r.head for r in folded.groupBy("key").agg(F.min(head).alias("head")).collect()}
        # a text in n // buckets is a bound: about as many as buckets, of HEAD characters
        chosen = folded.where(F.expr(f"pmod(xxhash64(text), {n // buckets}) = 0")).select("key", head.alias("head")).distinct()
        for r in chosen.collect():
            if r.head > lowest[r.key]:
                splits.setdefault(r.key, []).append(r.head)
        splits = {k: sorted(v) for k, v in splits.items()}
        rows = rows.where(~F.col("key").isin(heavy)).unionByName(folded.drop("n"))
    bounds = np.array(sorted({*cuts, *heavy}), np.int64)
    # region i starts at bounds[i], going down, and has a bucket for each split of that id and one more
    width = np.array([1 + len(splits.get(k, ())) for k in bounds.tolist()] + [1], np.int64)
    base = np.concatenate([np.cumsum(width[::-1])[::-1][1:], [0]]).astype(np.int64)

    @F.arrow_udf("int")
    def region_of(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, keys.to_numpy(), "left").astype(np.int32))

    # one row a region, at most as many as bounds
    top = {r.region: r.top for r in ids.select("key", region_of("key").alias("region")).groupBy("region").agg(F.max("key").alias("top")).collect()}
    starts: list[tuple[int, int, str | None]] = []
    for region in sorted(top, reverse=True):
        key, first = top[region], int(base[region])
        starts.append((first, key, lowest.get(key)))
        starts += [(first + j, key, s) for j, s in enumerate(splits.get(key, ()), 1)]
    # the first bucket's first row follows the last bucket
    before = {(key, s): starts[i - 1][0] for i, (_, key, s) in enumerate(starts)}
    tops = np.array(sorted(key for key, s in before if s is None), np.int64)
    prior = np.array([before[key, None] for key in tops.tolist()], np.int64)
    heavies = np.array(heavy, np.int64)

    @F.arrow_udf("array<struct<b:int,guest:boolean>>")
    def places(keys: pa.Array, heads: pa.Array) -> pa.Array:
        k = keys.to_numpy()
        region = np.searchsorted(bounds, k, "left")
        own = base[region] + width[region] - 1
        at = np.minimum(np.searchsorted(tops, k), max(len(tops) - 1, 0))
        first = tops[at] == k if len(tops) else np.zeros(len(k), bool)
        other = prior[at] if len(tops) else np.zeros(len(k), np.int64)
        for i in np.flatnonzero(np.isin(k, heavies)).tolist():
            key, start = int(k[i]), heads[i].as_py()
            own[i] = base[region[i]] + bisect_right(splits.get(key, ()), start)
            first[i] = (key, start) in before
            other[i] = before.get((key, start), 0)
        offsets = np.concatenate([[0], np.cumsum(1 + first.astype(np.int32))]).astype(np.int32)
        b = np.empty(offsets[-1], np.int32)
        guest = np.zeros(offsets[-1], bool)
        b[offsets[:-1]] = own
        b[offsets[:-1][first] + 1] = other[first]
        guest[offsets[:-1][first] + 1] = True
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(b), pa.array(guest)], ["b", "guest"]))

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = (
        rows.withColumn("place", F.explode(places("key", head if heavy else F.lit(""))))
        .select("place.b", "place.guest", "key", "id", "text")
        .repartition(parts, "b")
        .sortWithinPartitions(F.col("b"), F.col("guest"), F.col("key").desc(), F.col("text"))
    )

    def walk(batches):
        held = None  # the row that waits for its next one
        fresh: dict[str, list] = {}

        def empty():
            return {c: [] for c in ("id", "n_chars", "fingerprint", "edited_text", "edited_fingerprint", "near_edited", "near_next")}

        def put(row, following):
            text, own = row[2], row[3]
            changed = edited(text, following[2])
            mark = digest(changed.encode())
            for c, v in zip(fresh, (row[1], len(text), own, changed, mark, likeness(own, mark), likeness(own, following[3])), strict=True):
                fresh[c].append(v)

        closed = -1  # the bucket whose first guest has been used
        fresh = empty()
        for batch in batches:
            for b, guest, i, text in zip(*(batch.column(c).to_pylist() for c in ("b", "guest", "id", "text")), strict=True):
                if guest and closed == b:
                    continue  # the other rows of a repeated id
                row = (b, i, text, digest(text.encode()))
                if held is not None:
                    put(held, row)
                held = None if guest else row
                closed = b if guest else closed
            if fresh["id"]:
                yield pa.RecordBatch.from_pydict(fresh, schema)
                fresh = empty()

    schema = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string()), ("edited_text", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    shape = "id long, n_chars long, fingerprint string, edited_text string, edited_fingerprint string, near_edited double, near_next double"
    walked = dealt.mapInArrow(walk, shape)
    if folded is None:
        return walked

    def alone(batches):
        for batch in batches:
            out = {c: [] for c in (*schema.names, "copies")}
            for i, text, copies in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "copies")), strict=True):
                own, changed = digest(text.encode()), edited(text, text)
                mark = digest(changed.encode())
                for c, v in zip(out, (i, len(text), own, changed, mark, likeness(own, mark), 1.0, copies), strict=True):
                    out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema.append(pa.field("copies", pa.int64())))

    # all but one row of each group of equal rows are followed by an equal one
    shares_of = folded.where("n > 1").select("id", "text", "n", F.explode(F.expr(f"sequence(0L, (n - 2) div {COPIES})")).alias("share"))
    sized = shares_of.select("id", "text", "share", F.least(F.lit(COPIES), F.col("n") - 1 - F.col("share") * COPIES).alias("copies")).repartition(parts, F.xxhash64("text"), "share")
    copied = sized.select("id", "text", "copies").mapInArrow(alone, f"{shape}, copies long")
    return walked.unionByName(copied.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).drop("copies", "copy"))
