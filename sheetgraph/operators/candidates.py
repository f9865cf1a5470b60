"""What each end of a line connects to: symbols, texts and other lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetgraph.functions import geometry as g
from sheetgraph.operators.spatial import box_join, moved

KEY = ["sheet_id"]
SIDES = (("start", "x1", "y1"), ("end", "x2", "y2"))
SLOT = "struct<node:long,type:string,distance:double,intersection:boolean>"


def with_extension(lines: DataFrame, padding: float) -> DataFrame:
    """lines with ex1, ey1, ex2, ey2: each is extended once, not once for each pair."""
    e = g.extended(g.box(), padding)
    return lines.withColumns({f"e{n}": c for n, c in zip(("x1", "y1", "x2", "y2"), e, strict=True)})


def near_boxes(lines: DataFrame, boxes: DataFrame, item: str, kind: str, phase: int, threshold: float, buffer: float, padding: float, cell: float) -> DataFrame:
    """(line_ix, side, node, type, distance, phase): boxes within `threshold` of the nearer end of a line whose extension meets them.

    An end must be within the threshold, so ends and boxes are matched by cells of about
    that size, however far the extension reaches. Ties of the two ends go to the start.
    """
    ends = with_extension(lines, padding).select(*KEY, "line_ix", *[F.col(c).alias(f"_l{c}") for c in ("x1", "y1", "x2", "y2")], *[F.col(f"e{c}").alias(f"_e{c}") for c in ("x1", "y1", "x2", "y2")], F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(x).alias("px"), F.col(y).alias("py")) for s, x, y in SIDES])).alias("_end")).select("*", "_end.*").drop("_end")
    b = boxes.select(*KEY, F.col(item).alias("node"), *[F.col(c).alias(f"_q{c}") for c in ("x1", "y1", "x2", "y2")])
    q, line = g.box("_q"), g.box("_l")
    p = (F.col("px"), F.col("py"))
    met = box_join(ends, b, KEY, (*p, *p), tuple(q), threshold, cell)
    start, end = g.point_box(line.x1, line.y1, q), g.point_box(line.x2, line.y2, q)
    own = F.when(F.col("side") == "start", start <= end).otherwise(end < start)
    distance = F.when(F.col("side") == "start", start).otherwise(end)
    hit = met.where(own).withColumn("distance", distance).where((F.col("distance") <= threshold) & (g.segment_box(g.box("_e"), q) <= buffer))
    return hit.select(*KEY, "line_ix", "side", "node", F.lit(kind).alias("type"), "distance", F.lit(phase).alias("phase"))


def first_holders(*hits: DataFrame) -> DataFrame:
    """The holder of each end after symbols and texts: the least distance; ties go to the earlier phase and item. A partial aggregate."""
    every = hits[0]
    for h in hits[1:]:
        every = every.unionByName(h)
    best = moved(every, KEY).groupBy(*KEY, "line_ix", "side").agg(F.min(F.struct("distance", "phase", "node", "type")).alias("b"))
    return best.select(*KEY, "line_ix", "side", "b.node", "b.type", "b.distance", F.lit(False).alias("intersection"))


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo, lo + 1, ... for n places each, one after another."""
    return np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def _to_segment(px, py, s):
    """Distance of points to segments; an end is taken as it is given, so a segment along an axis is met exactly."""
    x1, y1, x2, y2 = s
    dx, dy = x2 - x1, y2 - y1
    n = dx * dx + dy * dy
    t = np.clip(np.divide((px - x1) * dx + (py - y1) * dy, n, out=np.zeros_like(n), where=n > 0), 0.0, 1.0)
    x, y = px - np.where(t == 1, x2, x1 + t * dx), py - np.where(t == 1, y2, y1 + t * dy)
    return np.sqrt(x * x + y * y)


def _segments_apart(a, b):
    """Distance of segments; 0 where they properly cross."""
    cross = lambda ox, oy, ax, ay, bx, by: (ax - ox) * (by - oy) - (ay - oy) * (bx - ox)
    least = np.minimum.reduce([_to_segment(*p, q) for p, q in ((a[:2], b), (a[2:], b), (b[:2], a), (b[2:], a))])
    through = lambda p, q: cross(*p, *q[:2]) * cross(*p, *q[2:]) < 0
    return np.where(through(b, a) & through(a, b), 0.0, least)


def _meeting(body: np.ndarray, longer: np.ndarray, names: np.ndarray, threshold: float, buffer: float, cell: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(line, target, sp, ep, sl, el) of one sheet's lines, by their places in it, in chunks of targets.

    Ends are put in order by rows of cells, so the ends near a target are a few spans of that order.
    """
    known = np.flatnonzero(np.isfinite(body).all(axis=0))
    ends = np.concatenate([2 * known, 2 * known + 1])  # a line's start and end
    ex, ey = (body[[k, k + 2]].T.reshape(-1)[ends] for k in (0, 1))
    place = lambda v: np.floor(v / cell).astype(np.int64)
    cx, cy = place(ex), place(ey)
    left, width = (cx.min(), np.ptp(cx) + 1) if len(cx) else (0, 1)
    order = np.argsort(cy * width + cx - left, kind="stable")
    ends, ex, ey, code = ends[order], ex[order], ey[order], (cy * width + cx - left)[order]
    x1, x2 = (f(body[0], body[2]) for f in (np.minimum, np.maximum))
    y1, y2 = (f(body[1], body[3]) for f in (np.minimum, np.maximum))
    for part in np.array_split(known, len(known) // 500 + 1):
        top, rows = place(y1[part] - threshold), place(y2[part] + threshold) - place(y1[part] - threshold) + 1
        row, t = _ranges(top, rows), np.repeat(part, rows)
        lo, hi = (np.clip(place(v) - left, -1, width) for v in (x1[t] - threshold, x2[t] + threshold))
        lo, hi = np.searchsorted(code, row * width + np.maximum(lo, 0)), np.searchsorted(code, row * width + np.minimum(hi, width - 1), side="right")
        n = np.maximum(hi - lo, 0)
        e, t = _ranges(lo, n), np.repeat(t, n)
        px, py = ex[e], ey[e]
        near = (px >= x1[t] - threshold) & (px <= x2[t] + threshold) & (py >= y1[t] - threshold) & (py <= y2[t] + threshold) & (names[ends[e] // 2] != names[t])
        e, t = ends[e[near]], t[near]
        line, q = e // 2, body[:, t]
        a = body[:, line]
        sl, el = _to_segment(a[0], a[1], q), _to_segment(a[2], a[3], q)
        # a pair that meets by both ends counts at its start
        own = np.where(e % 2 == 0, sl < threshold, (el < threshold) & ~(sl < threshold))
        line, t, sl, el = line[own], t[own], sl[own], el[own]
        meets = _segments_apart(longer[:, line], longer[:, t]) <= 2 * buffer
        line, t, sl, el = line[meets], t[meets], sl[meets], el[meets]
        a, q = body[:, line], body[:, t]
        apart = lambda i, j: np.sqrt((a[i] - q[j]) ** 2 + (a[i + 1] - q[j + 1]) ** 2)  # noqa: B023, E731
        yield line, t, np.minimum(apart(0, 0), apart(0, 2)), np.minimum(apart(2, 0), apart(2, 2)), sl, el


def with_near(lines: DataFrame, threshold: float, buffer: float, padding: float, cell: float) -> DataFrame:
    """lines with `near`: (target, sp, ep, sl, el) in order of target, what near_lines() has of each line.

    A sheet's lines meet in one group, where they lie already if its lines were numbered, so pairs never move.
    """
    longer = with_extension(lines, padding)
    near = T.StructType([T.StructField("target", lines.schema["line_ix"].dataType), *[T.StructField(c, T.DoubleType()) for c in ("sp", "ep", "sl", "el")]])
    schema = T.StructType([*lines.schema.fields, T.StructField("near", T.ArrayType(near))])
    columns = lines.columns

    def run(table: pa.Table) -> pa.Table:
        number = lambda c: table[c].to_numpy().astype(float)
        ix = table["line_ix"].combine_chunks()
        body, longer = (np.array([number(p + c) for c in ("x1", "y1", "x2", "y2")]) for p in ("", "e"))
        if table[KEY[0]].null_count:  # no sheet, no neighbours
            body[:] = np.nan
        names = ix.to_numpy(zero_copy_only=False)
        got = [np.concatenate(c) for c in zip(*_meeting(body, longer, names, threshold, buffer, cell), strict=True)]
        order = np.lexsort((names[got[1]], got[0]))
        line, target, *values = (c[order] for c in got)
        offsets = np.searchsorted(line, np.arange(len(names) + 1)).astype(np.int32)
        pairs = pa.StructArray.from_arrays([ix.take(pa.array(target)), *map(pa.array, values)], ["target", "sp", "ep", "sl", "el"])
        return table.select(columns).append_column("near", pa.ListArray.from_arrays(pa.array(offsets), pairs))

    return longer.groupBy(*KEY).applyInArrow(run, schema)


def near_lines(lines: DataFrame, threshold: float, buffer: float, padding: float, cell: float) -> DataFrame:
    """(line_ix, target, sp, ep, sl, el): distances of a line's ends to each target's nearer end and body.

    Every rule needs an end within the threshold of the target's body, so those pairs alone
    are made (by cells), and the extensions' meeting is tested on them.
    """
    return with_near(lines, threshold, buffer, padding, cell).select(*KEY, "line_ix", F.explode("near").alias("_n")).select(*KEY, "line_ix", "_n.*")


def _locked(slot: Column, contact: float) -> Column:
    held = slot["type"].isin("symbol", "text") & (slot["distance"] <= contact)
    return F.coalesce(held, F.lit(False)) if contact > 0 else F.lit(False)


def fold_lines(holders: DataFrame, targets: DataFrame, lines: DataFrame, threshold: float, contact: float = 0.0, prefer_symbols: bool = False) -> DataFrame:
    """(line_ix, start, end): the slots of each line after its target lines, folded in order of target."""
    near = targets.groupBy(*KEY, "line_ix").agg(F.array_sort(F.collect_list(F.struct("target", "sp", "ep", "sl", "el"))).alias("near"))
    return fold_near(with_held(lines.select(*KEY, "line_ix"), holders).join(near, [*KEY, "line_ix"], "left"), threshold, contact, prefer_symbols)


def with_held(lines: DataFrame, holders: DataFrame) -> DataFrame:
    """lines with the slots `start` and `end` of what holds their ends, null if nothing does."""
    slot = F.struct("node", "type", "distance", "intersection")
    return lines.join(holders.groupBy(*KEY, "line_ix").agg(*[F.max(F.when(F.col("side") == s, slot)).alias(s) for s, _, _ in SIDES]), [*KEY, "line_ix"], "left")


def fold_near(lines: DataFrame, threshold: float, contact: float = 0.0, prefer_symbols: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(line_ix, start, end) of lines that have their slots and `near`, the lines beside them in order of target; columns `keep` stay.

    The result depends on the order, since what holds a slot decides what may replace it; so
    this is an ordered fold in Catalyst, not a minimum.
    """

    def point_wins(slot: Column, d: Column) -> Column:
        ok = F.coalesce(slot["intersection"], F.lit(False)) | slot["distance"].isNull() | (d < slot["distance"])
        return ok & ~_locked(slot, contact) & (F.lit(not prefer_symbols) | ~F.coalesce(slot["type"].isin("symbol", "text"), F.lit(False)))

    def body_wins(slot: Column, d: Column) -> Column:
        box = F.coalesce(slot["type"].isin("symbol", "text"), F.lit(False))
        ok = slot["distance"].isNull() | ((F.coalesce(slot["intersection"], F.lit(False)) | box) & (d < slot["distance"]))
        return ok & ~_locked(slot, contact) & (F.lit(not prefer_symbols) | ~box)

    def step(acc: Column, x: Column) -> Column:
        new = lambda d, crossing: F.struct(x["target"].alias("node"), F.lit("line").alias("type"), d.alias("distance"), F.lit(crossing).alias("intersection"))
        s, e = acc["start"], acc["end"]
        put = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
        rules = [
            ((x["sp"] <= x["ep"]) & (x["sp"] < threshold) & point_wins(s, x["sp"]), put(new(x["sp"], False), e)),
            ((x["ep"] < x["sp"]) & (x["ep"] < threshold) & point_wins(e, x["ep"]), put(s, new(x["ep"], False))),
            ((x["sl"] <= x["el"]) & (x["sl"] < threshold) & body_wins(s, x["sl"]), put(new(x["sl"], True), e)),
            ((x["el"] < x["sl"]) & (x["el"] < threshold) & body_wins(e, x["el"]), put(s, new(x["el"], True))),
        ]
        out = F.when(rules[0][0], rules[0][1])
        for c, v in rules[1:]:
            out = out.when(c, v)
        return out.otherwise(acc)

    empty = F.lit(None).cast("array<struct<target:long,sp:double,ep:double,sl:double,el:double>>")
    start = F.struct(*[F.coalesce(F.col(s).cast(SLOT), F.struct(F.lit(None).cast("long").alias("node"), F.lit("unknown").alias("type"), F.lit(None).cast("double").alias("distance"), F.lit(False).alias("intersection"))).alias(s) for s, _, _ in SIDES])
    folded = F.aggregate(F.coalesce("near", F.coalesce(empty, F.array().cast("array<struct<target:long,sp:double,ep:double,sl:double,el:double>>"))), start, step)
    return lines.select(*KEY, "line_ix", folded.alias("f"), *keep).select(*KEY, "line_ix", "f.start", "f.end", *keep)


def ray_hits(lines: DataFrame, symbols: DataFrame, most: float, cell: float) -> DataFrame:
    """(line_ix, side, node, distance): the first symbol along each end's outward ray, within `most`; ties go to the smaller id."""
    n = g.length(g.box())
    ux, uy = F.try_divide(F.col("x2") - F.col("x1"), n), F.try_divide(F.col("y2") - F.col("y1"), n)
    ends = F.array(F.struct(F.lit("start").alias("side"), F.col("x1").alias("px"), F.col("y1").alias("py"), (-ux).alias("ux"), (-uy).alias("uy")), F.struct(F.lit("end").alias("side"), F.col("x2").alias("px"), F.col("y2").alias("py"), ux.alias("ux"), uy.alias("uy")))
    e = lines.where(n > 0).select(*KEY, "line_ix", F.explode(ends).alias("_e")).select(*KEY, "line_ix", "_e.*")
    s = symbols.select(*KEY, F.col("symbol_id").alias("node"), *[F.col(c).alias(f"_q{c}") for c in ("x1", "y1", "x2", "y2")])
    p = (F.col("px"), F.col("py"))
    met = box_join(e, s, KEY, (*p, *p), tuple(g.box("_q")), most, cell)
    d = met.withColumn("distance", g.ray_box(F.col("px"), F.col("py"), F.col("ux"), F.col("uy"), g.box("_q"))).where(F.col("distance") <= most)
    best = d.groupBy(*KEY, "line_ix", "side").agg(F.min(F.struct("distance", "node")).alias("b"))
    return best.select(*KEY, "line_ix", "side", "b.node", "b.distance")


def candidates(lines: DataFrame, symbols: DataFrame, texts: DataFrame, unit: float, thresholds: dict[str, float] | None = None, padding: float = 0.2) -> DataFrame:
    """(line_ix, side, node, type, distance, intersection) of every end that connects; distances are fractions of `unit` pixels."""
    px = {"symbols": 12.0, "texts": 5.0, "lines": 50.0, "buffer": 5.0, "contact": 2.0, "ray": 60.0} | (thresholds or {})
    px = {k: v / unit for k, v in px.items()}
    cell = 100.0 / unit
    holders = first_holders(near_boxes(lines, symbols, "symbol_id", "symbol", 0, px["symbols"], px["buffer"], padding, cell), near_boxes(lines, texts, "text_ix", "text", 1, px["texts"], px["buffer"], padding, cell))
    # what holds an end, or is met by its ray, is joined to the lines first, so the long lists of lines beside them are folded where they are made
    met = F.struct(F.col("node").alias("_n"), F.col("distance").alias("_d"))
    rays = ray_hits(lines, symbols, px["ray"], cell).groupBy(*KEY, "line_ix").agg(*[F.max(F.when(F.col("side") == s, met)).alias(f"_{s}") for s, _, _ in SIDES])
    held = with_held(lines, holders).join(rays, [*KEY, "line_ix"], "left")
    folded = fold_near(with_near(held, px["lines"], px["buffer"], padding, cell), px["lines"], px["contact"], keep=("_start", "_end"))
    ends = folded.select(*KEY, "line_ix", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("slot"), F.col(f"_{s}").alias("ray")) for s, _, _ in SIDES])).alias("e"))
    out = ends.select(*KEY, "line_ix", "e.side", "e.slot.*", "e.ray.*")
    free = F.col("node").isNull() & F.col("_n").isNotNull()
    return out.select(*KEY, "line_ix", "side", F.coalesce("node", "_n").alias("node"), F.when(free, F.lit("symbol")).otherwise(F.col("type")).alias("type"), F.coalesce("distance", "_d").alias("distance"), "intersection").where("node is not null")
