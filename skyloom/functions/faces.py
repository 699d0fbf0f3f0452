"""Repair of rings that meet themselves: which of their faces count, and the border of those."""

from __future__ import annotations

import math
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions.ring import meets_itself

#: Exact, so that sides through one point agree on it.
Point = tuple[Fraction, Fraction]


def _turn(a: Point, b: Point, p: Point) -> Fraction:
    return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])


def _noded(ring: list[Point]) -> dict[tuple[Point, Point], int]:
    """The sides cut where they meet: (a, b) with a < b, and how often a-b is walked, less b-a."""
    sides = [(p, q) for p, q in zip(ring, ring[1:] + ring[:1], strict=True) if p != q]
    cuts: list[set[Point]] = [{p, q} for p, q in sides]
    for i, (p, q) in enumerate(sides):
        for j, (r, s) in enumerate(sides[:i]):
            a, b, c, d = _turn(p, q, r), _turn(p, q, s), _turn(r, s, p), _turn(r, s, q)
            if a * b < 0 and c * d < 0:
                t = c / (c - d)
                x = (p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1]))
                cuts[i].add(x)
                cuts[j].add(x)
                continue
            for side, points, turns in ((i, (r, s), (a, b)), (j, (p, q), (c, d))):
                u, v = sides[side]
                cuts[side].update(x for x, turn in zip(points, turns, strict=True) if turn == 0 and min(u[0], v[0]) <= x[0] <= max(u[0], v[0]) and min(u[1], v[1]) <= x[1] <= max(u[1], v[1]))
    walked: dict[tuple[Point, Point], int] = {}
    for (p, q), points in zip(sides, cuts, strict=True):
        along = sorted(points, key=lambda x: (x[0] - p[0]) * (q[0] - p[0]) + (x[1] - p[1]) * (q[1] - p[1]))
        for a, b in zip(along, along[1:], strict=False):
            edge, step = ((a, b), 1) if a < b else ((b, a), -1)
            walked[edge] = walked.get(edge, 0) + step
    return {edge: n for edge, n in walked.items() if n}


def _winding_left(edge: tuple[Point, Point], walked: dict[tuple[Point, Point], int]) -> int:
    """The winding number on the left of an edge: the edges between it and the outside, counted by their direction."""
    a, b = edge
    x, y, dx, dy = (a[0] + b[0]) / 2, (a[1] + b[1]) / 2, b[0] - a[0], b[1] - a[1]
    found = 0
    for (c, e), n in walked.items():
        if (c, e) == edge:
            continue
        tc, te = (c[0] - x) * dx + (c[1] - y) * dy, (e[0] - x) * dx + (e[1] - y) * dy
        if (tc > 0) != (te > 0):
            sc, se = (c[1] - y) * dx - (c[0] - x) * dy, (e[1] - y) * dx - (e[0] - x) * dy
            if sc - tc / (te - tc) * (se - sc) > 0:
                found += -n if te > tc else n
    return found


def _borders(steps: list[tuple[Point, Point]]) -> list[list[Point]]:
    """Directed edges joined to closed walks; walks that touch in a corner are one."""
    after: dict[Point, list[Point]] = {}
    for a, b in steps:
        after.setdefault(a, []).append(b)
    rings = []
    for start in list(after):
        while after[start]:
            ring, before, at = [start], start, after[start].pop()
            while at != start or after.get(at):
                if not after.get(at):
                    break
                back = math.atan2(before[1] - at[1], before[0] - at[0])
                onward = max(after[at], key=lambda c, at=at, back=back: (back - math.atan2(c[1] - at[1], c[0] - at[0])) % (2 * math.pi))
                after[at].remove(onward)
                ring.append(at)
                before, at = at, onward
            rings.append(ring)
    return rings


def area(ring: list[Point]) -> Fraction:
    x0, y0 = ring[0]
    return sum((p[0] - x0) * (q[1] - y0) - (q[0] - x0) * (p[1] - y0) for p, q in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def repair(corners: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The border of the faces that the ring winds around in its own sense, which is that of its signed area (counter-clockwise if it has none).

    Of a bowtie that is the larger lobe. Faces that are apart, and holes, are joined
    by bridges: sides walked both ways, which bound nothing.
    """
    ring = [(Fraction(x), Fraction(y)) for x, y in corners]
    whole = area(ring)
    sense = 1 if whole >= 0 else -1
    walked = _noded(ring)
    steps = []
    for (a, b), n in walked.items():
        left = _winding_left((a, b), walked)
        inside, beyond = left * sense > 0, (left - n) * sense > 0
        if inside != beyond:
            steps.append((a, b) if inside else (b, a))
    found = sorted(_borders(steps), key=lambda r: -abs(area(r)))
    if not found:
        return corners
    joined = found[0]
    for other in found[1:]:
        joined = [*joined, joined[0], *other, other[0]]
    return [(float(x), float(y)) for x, y in joined]


def _repaired(rings: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    return pa.array([None if r is None else [{"x": x, "y": y} for x, y in repair([(c["x"], c["y"]) for c in r])] for r in rings.to_pylist()], kind)


def repaired(df: DataFrame, ring_col: str = "ring", flag: str = "repaired") -> DataFrame:
    """df with rings that meet themselves repaired, and a flag for these; Python sees them alone."""
    # the id keeps the flag in a step of its own: Python's arguments cannot hold the lambdas that it is made of
    broken = meets_itself(F.col(ring_col)) & (F.monotonically_increasing_id() >= 0)
    repair_rings = F.arrow_udf(_repaired, "array<struct<x:double,y:double>>").asNondeterministic()
    return df.withColumn(flag, broken).withColumn(ring_col, F.coalesce(repair_rings(F.when(F.col(flag), F.col(ring_col))), F.col(ring_col)))
