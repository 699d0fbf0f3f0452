"""Expressions on rings: arrays of (x, y) corners, not closed unless said so."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def rectangle(x0: Column, y0: Column, width: Column, height: Column) -> Column:
    """Counter-clockwise in a y-up map."""
    return F.array(point(x0, y0), point(x0 + width, y0), point(x0 + width, y0 + height), point(x0, y0 + height))


def closed(ring: Column) -> Column:
    """The first corner repeated at the end."""
    return F.concat(ring, F.slice(ring, 1, 1))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sides(ring: Column) -> Column:
    """(a, b) for each side."""

    def paired(r: Column) -> Column:
        following = F.concat(F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 1, 1))
        return F.zip_with(r, following, lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    return _let(ring, paired)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def signed_area(ring: Column) -> Column:
    """Shoelace; positive for counter-clockwise rings."""
    return _sum(F.transform(sides(ring), lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"])) / 2


def area(ring: Column) -> Column:
    """G06."""
    return F.abs(signed_area(ring))


def centroid(ring: Column) -> Column:
    """Area centroid (G07), the vertex mean where there is no area."""
    cross = lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]

    def of(r: Column) -> Column:
        cx = _sum(F.transform(sides(r), lambda s: (s["a"]["x"] + s["b"]["x"]) * cross(s)))
        cy = _sum(F.transform(sides(r), lambda s: (s["a"]["y"] + s["b"]["y"]) * cross(s)))
        return _let(signed_area(r) * 6, lambda six: F.when(six != 0, point(cx / six, cy / six)).otherwise(vertex_mean(r)))

    return _let(ring, of)


def vertex_mean(ring: Column) -> Column:
    """Mean of the corners."""
    n = F.size(ring)
    return F.when(n > 0, point(_sum(F.transform(ring, lambda p: p["x"])) / n, _sum(F.transform(ring, lambda p: p["y"])) / n))


def bounds(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def counter_clockwise(ring: Column) -> Column:
    return _let(ring, lambda r: F.when(signed_area(r) < 0, F.reverse(r)).otherwise(r))


def _turn(a: Column, b: Column, p: Column) -> Column:
    """Positive if p lies to the left of a-b."""
    return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])


def contains_strictly(hull: Column, p: Column) -> Column:
    """Whether p is inside a counter-clockwise convex ring, its border excluded."""
    return left_of_all(sides(hull), p)


def left_of_all(sides: Column, p: Column) -> Column:
    """Whether p lies to the left of each of these sides."""
    return F.forall(sides, lambda s: _turn(s["a"], s["b"], p) > 0)


def _meet(p: Column, q: Column, r: Column, s: Column) -> Column:
    """Whether the sides p-q and r-s share a point, ends included."""
    near = lambda c: (F.greatest(p[c], q[c]) >= F.least(r[c], s[c])) & (F.greatest(r[c], s[c]) >= F.least(p[c], q[c]))
    return near("x") & near("y") & (_turn(p, q, r) * _turn(p, q, s) <= 0) & (_turn(r, s, p) * _turn(r, s, q) <= 0)


def contains(ring: Column, p: Column) -> Column:
    """Whether p is inside a ring by the number of sides to its right; points on the border may count either way."""

    def right(s: Column) -> Column:
        up = s["b"]["y"] > s["a"]["y"]
        return ((s["a"]["y"] > p["y"]) != (s["b"]["y"] > p["y"])) & (up == (_turn(s["a"], s["b"], p) > 0))

    return F.size(F.filter(sides(ring), right)) % 2 == 1


def border(ring: Column) -> Column:
    """The sides of a ring, without bridges, which are walked both ways."""
    return _let(sides(ring), lambda sides: F.filter(sides, lambda s: ~F.exists(sides, lambda t: (t["a"] == s["b"]) & (t["b"] == s["a"]))))


def intersects(one: Column, other: Column) -> Column:
    """Whether two rings share a point, convex or not; touching counts.

    Their borders meet, or one ring lies within the other: then so does its first corner.
    """

    def of(pair: Column) -> Column:
        a, b = pair["one"], pair["other"]
        meet = _let(border(b), lambda sides: F.exists(border(a), lambda s: F.exists(sides, lambda t: _meet(s["a"], s["b"], t["a"], t["b"]))))
        return meet | contains(a, F.get(b, F.lit(0))) | contains(b, F.get(a, F.lit(0)))

    return _let(F.struct(one.alias("one"), other.alias("other")), of)


def _crossing(a: Column, b: Column, p: Column, q: Column) -> Column:
    """Where the line a-b meets p-q."""
    at = _let(F.struct(_turn(a, b, p).alias("p"), _turn(a, b, q).alias("q")), lambda s: s["p"] / (s["p"] - s["q"]))
    return _let(at, lambda t: point(p["x"] + t * (q["x"] - p["x"]), p["y"] + t * (q["y"] - p["y"])))


def clip(ring: Column, window: Column) -> Column:
    """The part of a ring inside a counter-clockwise convex ring (Sutherland-Hodgman, G09)."""

    def cut(kept: Column, side: Column) -> Column:
        a, b = side["a"], side["b"]

        def keep(s: Column) -> Column:
            p, q = s["a"], s["b"]
            inside_p, inside_q = _turn(a, b, p) >= 0, _turn(a, b, q) >= 0
            none = F.slice(F.array(q), 1, 0)
            return F.when(inside_p & inside_q, F.array(q)).when(inside_p, F.array(_crossing(a, b, p, q))).when(inside_q, F.array(_crossing(a, b, p, q), q)).otherwise(none)

        return F.flatten(F.transform(sides(kept), keep))

    return F.aggregate(sides(window), ring, cut)


def _fan(ring: Column) -> Column:
    """Triangles from the first corner to each side, counter-clockwise, with the sense of each: those of a ring add up to its inside."""

    def of(r: Column) -> Column:
        first = F.get(r, F.lit(0))
        corners = F.transform(F.slice(sides(r), F.lit(2), F.greatest(F.size(r) - 2, F.lit(0))), lambda s: F.array(first, s["a"], s["b"]))
        sense = lambda t: F.when(_turn(F.get(t, F.lit(0)), F.get(t, F.lit(1)), F.get(t, F.lit(2))) < 0, -1).otherwise(1)
        return F.transform(corners, lambda t: F.struct(sense(t).alias("sense"), counter_clockwise(t).alias("corners")))

    return _let(ring, of)


def overlap_area(one: Column, other: Column) -> Column:
    """Area of the intersection of two simple rings of any number of corners, convex or not."""

    def shared(t: Column, windows: Column) -> Column:
        return _sum(F.transform(windows, lambda w: area(clip(t["corners"], w["corners"])) * (t["sense"] * w["sense"])))

    # rings of opposite senses would count their overlap as negative
    return F.abs(_let(_fan(other), lambda windows: _sum(F.transform(_fan(one), lambda t: shared(t, windows)))))


def meets_itself(ring: Column) -> Column:
    """Whether two sides that are not neighbours share a point."""

    def of(sides: Column) -> Column:
        n = F.size(sides)
        apart = lambda i, j: (j > i + 1) & ((i > 0) | (j < n - 1))
        later = lambda s, i: F.transform(sides, lambda t, j: apart(i, j) & _meet(s["a"], s["b"], t["a"], t["b"]))
        return F.exists(F.transform(sides, lambda s, i: F.exists(later(s, i), lambda met: met)), lambda met: met)

    return F.coalesce(_let(sides(ring), of), F.lit(False))
