"""Boxes and segments as tuples of columns, and what is computed from them.

Everything here is a Catalyst expression of doubles. A null coordinate gives a null result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


class Box(NamedTuple):
    """An axis-aligned box, x1 <= x2 and y1 <= y2; also a segment from (x1, y1) to (x2, y2)."""

    x1: Column
    y1: Column
    x2: Column
    y2: Column


def box(prefix: str = "") -> Box:
    return Box(*[F.col(f"{prefix}{c}") for c in ("x1", "y1", "x2", "y2")])


class NamedBox:
    """A box of columns by prefix that is looked up when used, so it can be named before a session exists."""

    def __init__(self, prefix: str = ""):
        self._prefix = prefix

    def __getattr__(self, name: str) -> Column:
        if name not in Box._fields:
            raise AttributeError(name)
        return F.col(f"{self._prefix}{name}")

    def __iter__(self):
        return iter(box(self._prefix))


def zero() -> Column:
    return F.lit(0.0)


# --- coordinates


def to_pixels(value: Column, size: Column | float) -> Column:
    """Pixels of a fraction, cut towards zero."""
    return (value * size).cast("int")


def to_fraction(value: Column, size: Column | float) -> Column:
    return value / size


def clamped_fraction(value: Column, size: Column | float) -> Column:
    return F.greatest(zero(), F.least(F.lit(1.0), value / size))


def threshold_fraction(pixels: Column | float, width: Column | float, height: Column | float) -> Column:
    """A distance in pixels along the longer side, as a fraction."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(float(x))
    return lit(pixels) / F.greatest(lit(width), lit(height))


def valid_fraction(b: Box) -> Column:
    inside = (b.x1 >= 0) & (b.y1 >= 0) & (b.x2 >= 0) & (b.y2 >= 0) & (b.x1 <= 1) & (b.y1 <= 1) & (b.x2 <= 1) & (b.y2 <= 1)
    return inside & (b.x1 <= b.x2) & (b.y1 <= b.y2)


def checked(b: Box, value: Column) -> Column:
    """value, or an error where the box is not valid."""
    return F.when(valid_fraction(b), value).otherwise(F.raise_error(F.lit("box is not within 0 to 1")))


def corners(b: Box) -> Column:
    """The corners, clockwise from the top left."""
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((b.x1, b.y1), (b.x2, b.y1), (b.x2, b.y2), (b.x1, b.y2))])


def sides(b: Box) -> Column:
    """Top, right, bottom and left side."""
    s = lambda n, *c: F.struct(F.lit(n).alias("side"), *[v.alias(k) for k, v in zip(("x1", "y1", "x2", "y2"), c, strict=True)])
    return F.array(s("top", b.x1, b.y1, b.x2, b.y1), s("right", b.x2, b.y1, b.x2, b.y2), s("bottom", b.x2, b.y2, b.x1, b.y2), s("left", b.x1, b.y2, b.x1, b.y1))


def expanded(b: Box, margin: float) -> Box:
    return Box(b.x1 - margin, b.y1 - margin, b.x2 + margin, b.y2 + margin)


def padded(b: Box, distance: float, axis: str) -> Box:
    """Half the distance added at both ends of one axis."""
    d = distance / 2
    return Box(b.x1 - d, b.y1, b.x2 + d, b.y2) if axis == "h" else Box(b.x1, b.y1 - d, b.x2, b.y2 + d)


def moved(b: Box, dx: Column, dy: Column) -> Box:
    return Box(b.x1 + dx, b.y1 + dy, b.x2 + dx, b.y2 + dy)


def rescaled(value: Column, scale: float) -> Column:
    """A coordinate found on an image enlarged by `scale`, on the original; halves go to the even pixel."""
    return F.bround(value / F.lit(float(scale))).cast("int")


# --- boxes


def area(b: Box) -> Column:
    return F.greatest(zero(), b.x2 - b.x1) * F.greatest(zero(), b.y2 - b.y1)


def overlap_area(a: Box, b: Box) -> Column:
    return F.greatest(zero(), F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)) * F.greatest(zero(), F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(zero())


def iou(a: Box, b: Box) -> Column:
    o = overlap_area(a, b)
    return _share(o, area(a) + area(b) - o)


def overlap_of_smaller(a: Box, b: Box) -> Column:
    return _share(overlap_area(a, b), F.least(area(a), area(b)))


def contained_share(inner: Box, outer: Box) -> Column:
    return _share(overlap_area(inner, outer), area(inner))


def overlaps_more_than(a: Box, b: Box, share: float) -> Column:
    return contained_share(a, b) > share


def gap(a: Box, b: Box) -> Column:
    """Distance of two boxes; 0 where they touch or overlap."""
    return F.hypot(F.greatest(a.x1 - b.x2, b.x1 - a.x2, zero()), F.greatest(a.y1 - b.y2, b.y1 - a.y2, zero()))


def inside(inner: Box, outer: Box, slack: float = 0.0) -> Column:
    return (inner.x1 >= outer.x1 - slack) & (inner.y1 >= outer.y1 - slack) & (inner.x2 <= outer.x2 + slack) & (inner.y2 <= outer.y2 + slack)


def inside_or_unbounded(inner: Box, outer: Box) -> Column:
    """inside(); true where there is no outer box."""
    return outer.x1.isNull() | inside(inner, outer)


def touches(a: Box, b: Box) -> Column:
    return (a.x1 <= b.x2) & (b.x1 <= a.x2) & (a.y1 <= b.y2) & (b.y1 <= a.y2)


def bounds(s: Box) -> Box:
    """The box around a segment."""
    return Box(F.least(s.x1, s.x2), F.least(s.y1, s.y2), F.greatest(s.x1, s.x2), F.greatest(s.y1, s.y2))


def axis_overlap(a: Box, b: Box, axis: str, share: float) -> Column:
    """The overlap along one axis is at least that share of either extent."""
    lo, hi = ("x1", "x2") if axis == "h" else ("y1", "y2")
    g = lambda q, c: getattr(q, c)
    o = F.least(g(a, hi), g(b, hi)) - F.greatest(g(a, lo), g(b, lo))
    return (o >= 0) & ((o >= share * (g(a, hi) - g(a, lo))) | (o >= share * (g(b, hi) - g(b, lo))))


def centre(b: Box) -> tuple[Column, Column]:
    return (b.x1 + b.x2) / 2, (b.y1 + b.y2) / 2


# --- segments


def slope(s: Box) -> Column:
    """dy / dx; infinite for a vertical segment."""
    return F.when(s.x2 == s.x1, F.lit(INF)).otherwise(F.try_divide(s.y2 - s.y1, s.x2 - s.x1))


def folded_angle(s: Box) -> Column:
    """Direction in degrees, from 0 to below 180."""
    return F.pmod(F.degrees(F.atan2(s.y2 - s.y1, s.x2 - s.x1)), F.lit(180.0))


def angle_gap(a: Column, b: Column) -> Column:
    d = F.abs(a - b)
    return F.least(d, 180 - d)


def length(s: Box) -> Column:
    return F.hypot(s.x2 - s.x1, s.y2 - s.y1)


def orientation(s: Box, degrees: float) -> Column:
    """'h', 'v' or null, for pixels; null for a point."""
    a = F.degrees(F.atan2(F.abs(s.y2 - s.y1), F.abs(s.x2 - s.x1)))
    return F.when((s.x1 == s.x2) & (s.y1 == s.y2), F.lit(None)).when(a <= degrees, F.lit("h")).when(a >= 90 - degrees, F.lit("v"))


def snapped(s: Box, degrees: float) -> Column:
    """struct(axis, level, lo, hi) of a near-axis segment of whole pixels; null for others. A point counts as horizontal."""
    a = F.abs(F.degrees(F.atan2(s.y2 - s.y1, s.x2 - s.x1)))
    a = F.least(a, 180 - a)
    out = lambda axis, p, q, u, v: F.struct(F.lit(axis).alias("axis"), F.floor((p + q) / 2).cast("long").alias("level"), F.least(u, v).cast("long").alias("lo"), F.greatest(u, v).cast("long").alias("hi"))
    return F.when(a <= degrees, out("h", s.y1, s.y2, s.x1, s.x2)).when(a >= 90 - degrees, out("v", s.x1, s.x2, s.y1, s.y2))


def ordered_ends(s: Box) -> Box:
    """The segment from left to right; from top to bottom if it is vertical."""
    turn = (s.x1 > s.x2) | ((s.x1 == s.x2) & (s.y1 > s.y2))
    pick = lambda a, b: F.when(turn, b).otherwise(a)
    return Box(pick(s.x1, s.x2), pick(s.y1, s.y2), pick(s.x2, s.x1), pick(s.y2, s.y1))


def extended(s: Box, padding: float) -> Box:
    """A segment of fractions made longer at both ends, to five decimals.

    A vertical one is kept within 0 and 1; of others x is, and y follows the line.
    """
    m, upright = slope(s), s.x1 == s.x2
    rise = F.when(upright, zero()).otherwise(m)
    left, right = F.greatest(s.x1 - padding, zero()), F.least(s.x2 + padding, F.lit(1.0))
    at = lambda x: s.y1 + rise * (x - s.x1)
    pick = lambda a, b: F.bround(F.when(upright, a).otherwise(b), 5)
    return Box(pick(s.x1, left), pick(F.greatest(s.y1 - padding, zero()), at(left)), pick(s.x2, right), pick(F.least(s.y2 + padding, F.lit(1.0)), at(right)))


def text_connector(b: Box, s: Box) -> Column:
    """A line through a text's box that goes on from the segment that reaches it: from its left, right, top or else bottom."""
    w, h = b.x2 - b.x1, b.y2 - b.y1
    return _four_ways(b, s, (s.x2, s.y2, s.x2 + w, s.y2), (s.x1 - w, s.y1, s.x1, s.y1), (s.x2, s.y2, s.x2, s.y2 + h), (s.x1, s.y1 - h, s.x1, s.y1))


def symbol_connector(b: Box, s: Box) -> Column:
    """The line that closes the space between a segment and a symbol's edge."""
    return _four_ways(b, s, (s.x2, s.y2, b.x1, s.y2), (b.x2, s.y1, s.x1, s.y1), (s.x2, s.y2, s.x2, b.y1), (s.x1, b.y2, s.x1, s.y1))


def _four_ways(b: Box, s: Box, left, right, top, bottom) -> Column:
    line = lambda c: F.struct(*[v.alias(k) for k, v in zip(("x1", "y1", "x2", "y2"), c, strict=True)])
    return F.when(s.x1 < b.x1, line(left)).when(s.x2 > b.x2, line(right)).when(s.y1 < b.y1, line(top)).otherwise(line(bottom))


def centre_connector(a: Box, b: Box) -> Box:
    return Box(*centre(a), *centre(b))


def line_connector(a: Box, b: Box) -> Column:
    """The line between those ends of two segments that are nearer to the other segment, leftmost (then topmost) end first."""
    p1 = point_segment(a.x1, a.y1, b) < point_segment(a.x2, a.y2, b)
    q1 = point_segment(b.x1, b.y1, a) < point_segment(b.x2, b.y2, a)
    px, py = F.when(p1, a.x1).otherwise(a.x2), F.when(p1, a.y1).otherwise(a.y2)
    qx, qy = F.when(q1, b.x1).otherwise(b.x2), F.when(q1, b.y1).otherwise(b.y2)
    o = ordered_ends(Box(px, py, qx, qy))
    return F.struct(*[v.alias(k) for k, v in zip(("x1", "y1", "x2", "y2"), o, strict=True)])


# --- distances


def point_segment(px: Column, py: Column, s: Box) -> Column:
    dx, dy = s.x2 - s.x1, s.y2 - s.y1
    n = dx * dx + dy * dy
    t = F.when(n == 0, zero()).otherwise(F.greatest(zero(), F.least(F.lit(1.0), F.try_divide((px - s.x1) * dx + (py - s.y1) * dy, n))))
    return F.hypot(px - (s.x1 + t * dx), py - (s.y1 + t * dy))


def point_box(px: Column, py: Column, b: Box) -> Column:
    return F.hypot(F.greatest(b.x1 - px, px - b.x2, zero()), F.greatest(b.y1 - py, py - b.y2, zero()))


def _cross(ox: Column, oy: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return (ax - ox) * (by - oy) - (ay - oy) * (bx - ox)


def segments_cross(a: Box, b: Box) -> Column:
    """The segments properly cross; touching ends have distance 0 anyway."""
    d1, d2 = _cross(b.x1, b.y1, b.x2, b.y2, a.x1, a.y1), _cross(b.x1, b.y1, b.x2, b.y2, a.x2, a.y2)
    d3, d4 = _cross(a.x1, a.y1, a.x2, a.y2, b.x1, b.y1), _cross(a.x1, a.y1, a.x2, a.y2, b.x2, b.y2)
    return (d1 * d2 < 0) & (d3 * d4 < 0)


def segment_segment(a: Box, b: Box) -> Column:
    ends = F.least(point_segment(a.x1, a.y1, b), point_segment(a.x2, a.y2, b), point_segment(b.x1, b.y1, a), point_segment(b.x2, b.y2, a))
    return F.when(segments_cross(a, b), zero()).otherwise(ends)


def segment_meets_box(s: Box, b: Box) -> Column:
    """The segment has a point in the box: its part within both slabs is not empty."""
    enter, leave = [F.lit(0.0)], [F.lit(1.0)]
    missed = F.lit(False)
    for p, q, lo, hi in ((s.x1, s.x2, b.x1, b.x2), (s.y1, s.y2, b.y1, b.y2)):
        missed = missed | ((p == q) & ((p < lo) | (p > hi)))
        t = [F.try_divide(edge - p, q - p) for edge in (lo, hi)]
        enter.append(F.coalesce(F.least(*t), F.lit(0.0)))
        leave.append(F.coalesce(F.greatest(*t), F.lit(1.0)))
    return ~missed & (F.greatest(*enter) <= F.least(*leave))


def segment_box(s: Box, b: Box) -> Column:
    """Distance of a segment and a filled box: from an end to the box or from a corner to the segment, unless they meet."""
    ends = [point_box(s.x1, s.y1, b), point_box(s.x2, s.y2, b)]
    return F.when(segment_meets_box(s, b), zero()).otherwise(F.least(*ends, *[point_segment(x, y, s) for x in (b.x1, b.x2) for y in (b.y1, b.y2)]))


def ray_box(px: Column, py: Column, ux: Column, uy: Column, b: Box) -> Column:
    """How far from a point along a direction a box begins, 0 from inside it; null if the ray misses it."""
    flat = lambda u: F.abs(u) < 1e-12
    enter, leave = [], []
    missed = F.lit(False)
    for p, u, lo, hi in ((px, ux, b.x1, b.x2), (py, uy, b.y1, b.y2)):
        missed = missed | (flat(u) & ((p < lo) | (p > hi)))
        t = [F.try_divide(edge - p, F.when(flat(u), F.lit(None)).otherwise(u)) for edge in (lo, hi)]
        enter.append(F.coalesce(F.least(*t), zero()))
        leave.append(F.coalesce(F.greatest(*t), F.lit(INF)))
    near, far = F.greatest(zero(), *enter), F.least(*leave)
    return F.when(~missed & (near <= far), near)
