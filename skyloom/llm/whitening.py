"""Operator 13: whitening of embeddings, with eigenvectors by FEAST contour integration.

Entries become integers, floor(SCALE * c) + OFFSET, so that sums and deviations
are exact. Spark reads the vectors three times: for counts and sums, for the
centred second moments, and for the projections. The covariance, a matrix of
the vectors' dimension (MAX_DIM at most), is all that reaches the driver.

There, inertia counts (signs of the pivots of a shifted LDL^T factorisation)
find intervals that hold the largest eigenvalues. For each, a contour around it
is integrated: shifted systems (z I - V) Y = B are solved at quadrature nodes z,
and their weighted sum projects a random block onto the eigenvectors inside.
Rayleigh-Ritz on that block gives eigenpairs, and the projection is repeated
until their residuals vanish. An interval in which fewer pairs are found than
its inertia counts tell is an error.

Defined results: rows whose vector is null or empty, or holds null or non-finite
entries, are left out, and so are vectors of another length than the most
frequent one (the longer of equals) and entries of LIMIT or more. Repeated rows count and are returned each
on its own. Components whose eigenvalue is zero (RANK of the trace) cannot be
whitened and have no rows, so a table of equal vectors gives none. A deviation
that does not fit a long is null. An empty table gives no rows. Other columns
pass through; any named deviation or whitened are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import free_name

SCALE, OFFSET = 1024, 100_000
#: Sides of the covariance that the driver may hold: 134 MB as doubles.
MAX_DIM = 4096
#: Entries of at least this magnitude are not used: their integers would not be exact as doubles, nor their sums as longs.
LIMIT = 2.0**30
#: Eigenvalues below this share of the trace count as zero.
RANK = 1e-12
#: Nodes of the quadrature on the upper half of a contour; the lower half mirrors it.
NODES = 12
#: Eigenvalues that one contour should hold at most; clusters that cannot be parted may be larger.
PER_CONTOUR = 4


def integers(vector: Column) -> Column:
    """The vector's entries as exact integers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)


def _usable(df: DataFrame, vector_col: str, name: str) -> DataFrame:
    """Rows with the integers as one more column, without vectors that cannot be used."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT)
    vector = F.col(vector_col)
    good = df.where(vector.isNotNull() & (F.size(vector) > 0)).where(F.forall(vector, finite))
    return good.withColumn(name, integers(vector))


@dataclass
class Model:
    """n vectors with sums per dimension, and components by falling eigenvalue."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _length(rows: DataFrame, name: str) -> int:
    """The most frequent length of a vector, the longer of equals; 0 without rows."""
    found = rows.groupBy(F.size(name).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return found[0].d if found else 0


def fit(df: DataFrame, vector_col: str = "embedding", components: int = 8) -> Model:
    """The largest components of all usable vectors."""
    name = free_name(df, "x")
    rows = _usable(df.select(vector_col), vector_col, name)
    d = _length(rows, name)
    if d == 0:
        return Model(0, np.zeros(0), np.zeros(0), np.zeros((0, 0)), 0.0)
    if d > MAX_DIM:
        raise ValueError(f"vectors of {d} entries; covariances of {MAX_DIM} are the largest")
    listed = rows.where(F.size(name) == d).select(F.col(name).alias("x"))
    n, sums = _sums(listed, d)
    moments = _moments(listed.withColumn("x", F.transform("x", lambda v: v.cast("double"))), d, np.array([s / n for s in sums]))
    covariance = moments / n
    values, vectors = largest(covariance, components)
    return Model(n, np.array(sums, dtype=object), values, vectors, float(np.trace(covariance)))


def _sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension: one row a task is combined."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d, np.int64)
            n, total = n + len(x), total + x.sum(0)
        yield pa.RecordBatch.from_pydict({"i": np.arange(d + 1), "v": np.concatenate([total, [n]]).astype(np.int64)})

    parts = rows.mapInArrow(partial, "i long, v long").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    found = {r.i: int(r.v) for r in parts.collect()}
    return found[d], [found[i] for i in range(d)]


def _moments(rows: DataFrame, d: int, centre: np.ndarray) -> np.ndarray:
    """Sums of products of centred entries; one matrix a task, summed row by row."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            y = _matrix(batch.column(0), d, np.float64) - centre
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "v"])

    parts = rows.mapInArrow(partial, "i long, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((d, d))
    out[found["i"].to_numpy(), found["j"].to_numpy()] = found["v"].to_numpy()
    return (out + out.T) / 2


def _matrix(column: pa.Array, d: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, d)


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed the shift: positive pivots of LDL^T with symmetric pivoting (1x1 and 2x2 blocks)."""
    a = matrix - shift * np.eye(len(matrix))
    positive, grow = 0, (1 + 17**0.5) / 8
    while len(a):
        n = len(a)
        p = int(np.argmax(np.abs(np.diagonal(a))))
        off = np.abs(a - np.diag(np.diagonal(a)))
        r, s = divmod(int(np.argmax(off)), n)
        if abs(a[p, p]) >= grow * off[r, s]:
            if a[p, p] == 0:
                return positive  # what is left is zero
            positive += a[p, p] > 0
            rest = np.delete(np.arange(n), p)
            column = a[rest, p]
            a = a[np.ix_(rest, rest)] - np.outer(column, column) / a[p, p]
        else:
            # a 2x2 pivot of this rule has one eigenvalue of each sign
            positive += 1
            rest = np.delete(np.arange(n), [r, s])
            block = a[np.ix_(rest, [r, s])]
            a = a[np.ix_(rest, rest)] - block @ np.linalg.solve(a[np.ix_([r, s], [r, s])], block.T)
    return positive


def intervals(matrix: np.ndarray, count: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) from the top down: `count` eigenvalues or more in all, or all that are not zero.

    Cuts are placed by bisection on inertia counts, so that no interval holds more
    than PER_CONTOUR eigenvalues, unless they are too close to be parted.
    """
    top, low = 1.01 * float(np.abs(matrix).sum(1).max()), RANK * float(np.trace(matrix))
    known = {top: 0}

    def above(x: float) -> int:
        if x not in known:
            known[x] = inertia(matrix, x)
        return known[x]

    def cut(a: float, b: float) -> list[tuple[float, float, int]]:
        inside = above(a) - above(b)
        if inside == 0 or above(b) >= count:
            return []
        if inside <= PER_CONTOUR or b - a <= 1e-9 * top:
            return [(a, b, inside)]
        middle = (a * b) ** 0.5  # in magnitude, as eigenvalues of covariances fall over many
        return cut(middle, b) + cut(a, middle)

    return cut(low, top)


def contour(matrix: np.ndarray, low: float, high: float, inside: int, seed: int = 0, sweeps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """The eigenpairs in low..high by FEAST; the block is widened if pairs are missing."""
    n = len(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (1 + nodes)
    scale = max(abs(high), abs(low), float(np.abs(matrix).max()))
    width = min(n, 2 * inside + 4)
    while True:
        block = np.random.default_rng(seed).standard_normal((n, width))
        for _ in range(sweeps):
            projected = np.zeros((n, block.shape[1]))
            for angle, weight in zip(angles, weights, strict=True):
                turn = radius * np.exp(1j * angle)
                projected += weight / 2 * (turn * np.linalg.solve((centre + turn) * np.eye(n) - matrix, block)).real
            # directions that the contour leaves out vanish; what remains is made orthonormal
            u, s, _ = np.linalg.svd(projected, full_matrices=False)
            basis = u[:, s > 1e-14 * s[0]]
            values, mixed = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ mixed
            found = (values >= low) & (values <= high)
            residual = np.abs(matrix @ vectors[:, found] - vectors[:, found] * values[found]).max(initial=0.0)
            if found.sum() == inside and residual <= 4e-14 * n**0.5 * scale:
                return values[found], vectors[:, found]
            block = vectors
        if found.sum() == inside and residual <= 1e-11 * scale:
            return values[found], vectors[:, found]
        if width == n:
            raise ArithmeticError(f"{found.sum()} eigenpairs in an interval of {inside}")
        width, seed = min(n, 2 * width), seed + 1


def largest(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The `count` largest eigenvalues, without zeros, and their vectors as columns, by falling eigenvalue."""
    trace = float(np.trace(matrix))
    pairs = [contour(matrix, *found) for found in intervals(matrix, count)] if trace > 0 else []
    if not pairs:
        return np.zeros(0), np.zeros((len(matrix), 0))
    # one Rayleigh-Ritz step over all intervals keeps vectors of neighbouring ones orthogonal
    basis, _ = np.linalg.qr(np.hstack([vectors for _, vectors in pairs]))
    values, mixed = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")[:count]
    order = order[values[order] > RANK * trace]
    return values[order], basis @ mixed[:, order]


def _spread(x: np.ndarray, n: int, sums: np.ndarray) -> int:
    """The largest |n x - S|, from each dimension's extremes."""
    ends = [x.min(0).tolist(), x.max(0).tolist()] if len(x) else []
    return max((abs(n * v - s) for end in ends for v, s in zip(end, sums.tolist(), strict=True)), default=0)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """The exact sums of (n x - S)^2, null where they pass a long."""
    most = max(n * int(np.abs(x).max(initial=0)), max(map(abs, sums.tolist()), default=0))
    if most < 2**62 and _spread(x, n, sums) ** 2 * x.shape[1] < 2**63:
        return pa.array(((n * x - sums.astype(np.int64)) ** 2).sum(1))
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums.tolist(), strict=True)) for row in x.tolist()]
    return pa.array([v if v < 2**63 else None for v in exact], pa.int64())


def whiten(df: DataFrame, model: Model, vector_col: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """keep (None: all columns) and deviation, and whitened, an array with one number for each component."""
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("deviation", "whitened")]
    n, sums, width, d = model.n, model.sums, len(model.values), len(model.sums)
    name = free_name(df, "x")
    rows = _usable(df, vector_col, name).where(F.size(name) == d).select(*kept, name)
    base = model.vectors / np.sqrt(model.values) if width else np.zeros((d, 0))
    centre = np.array([s / n for s in sums])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(len(kept)), d, np.int64)
            whitened = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * width, pa.array(((x - centre) @ base).ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _deviations(x, n, sums), whitened], [*kept, "deviation", "whitened"])

    schema = T.StructType([f for f in rows.schema.fields if f.name != name]).add("deviation", T.LongType()).add("whitened", T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(project, schema)


def identity_error(whitened: DataFrame, model: Model, col: str = "whitened") -> float:
    """The largest entry of the covariance of whitened vectors minus the identity."""
    width = len(model.values)
    if width == 0:
        return 0.0
    rows = whitened.select(F.col(col).alias("x"))
    sums = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    mean = np.zeros(width)
    for r in sums:
        mean[r.i] = r.v / model.n
    return float(np.abs(_moments(rows, width, mean) / model.n - np.eye(width)).max())
