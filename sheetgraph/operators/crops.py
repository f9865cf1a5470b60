"""A text's neighbourhood: its nearest symbol, its nearest lines on each side, and the crop they bound."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetgraph.functions import geometry as g
from sheetgraph.operators.spatial import box_join
from sheetgraph.plans.stages import drop_stash, stash


def nearest_symbol(texts: DataFrame, symbols: DataFrame, key: list[str], default: float = 1e9, first: float = 100.0) -> DataFrame:
    """texts with `symbol_distance`.

    Rings of growing reach are searched by cells; a text is done with the first ring that
    holds a symbol within its reach. Each minimum is a partial aggregate. Joins are of sorted sides: a symbol lies in
    several cells, so its table is larger than it is taken for, and the driver need not hold it.
    """
    s = symbols.select(*key, *[F.col(c).cast("double").alias(f"_s{c}") for c in ("x1", "y1", "x2", "y2")]).hint("merge")
    left = texts.select(*key, "text_ix", *[F.col(c).cast("double").alias(f"_t{c}") for c in ("x1", "y1", "x2", "y2")]).join(s.select(*key).distinct().hint("merge"), key, "left_semi")
    t, q = g.box("_t"), g.box("_s")
    each = lambda todo, reach: box_join(todo, s, key, tuple(t), tuple(q), reach, reach).groupBy(*key, "text_ix").agg(F.min(g.gap(t, q)).alias("symbol_distance"))
    found = _rings(left, [*key, "text_ix"], each, "symbol_distance", first)
    return texts.join(found.hint("merge"), [*key, "text_ix"], "left").withColumn("symbol_distance", F.coalesce("symbol_distance", F.lit(default)))


def _rings(todo: DataFrame, item: list[str], each: Callable[[DataFrame, float], DataFrame], distance: str, reach: float) -> DataFrame:
    """each(todo, reach) for growing reaches; an item whose distance is within the reach is done. Every item must have a finite distance."""
    todo, done = stash(todo, "todo"), []
    while True:
        near = stash(each(todo, reach).where(F.col(distance) <= reach), "ring")
        done.append(near)
        rest = stash(todo.join(near.select(*item).hint("merge"), item, "left_anti"), "todo")
        drop_stash(todo)
        todo = rest
        if todo.isEmpty():
            break
        reach *= 4
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def sides(texts: DataFrame, lines: DataFrame, key: list[str], first: float = 50.0) -> DataFrame:
    """texts with above, below, left and right: struct(line_ix, level, mid_x, mid_y) of the nearest line beyond that edge.

    lines are (line_ix, axis, pos, lo, hi). Nearness is the true distance from the box, not
    the offset of the line's level alone; ties go to the first line. A line lies beyond one edge at most, so a text meets
    the lines of a ring once and each side takes its least. Only texts with a side still open, of those that have a line at all,
    go on to the next ring.
    """
    b = g.box("_t")
    l = stash(lines.select(*key, "line_ix", "axis", F.col("pos").cast("double").alias("level"), F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi")), "lines")
    t = texts.select(*key, "text_ix", *[F.col(c).cast("double").alias(f"_t{c}") for c in ("x1", "y1", "x2", "y2")])
    lined = lambda axis, f: f(F.when(F.col("axis") == axis, F.col("level")))
    ends = l.groupBy(*key).agg(lined("h", F.min).alias("_h1"), lined("h", F.max).alias("_h2"), lined("v", F.min).alias("_v1"), lined("v", F.max).alias("_v2"))
    names = ("above", "below", "left", "right")
    has = [F.when(c, F.lit(n)) for n, c in zip(names, (F.col("_h1") < b.y1, F.col("_h2") > b.y2, F.col("_v1") < b.x1, F.col("_v2") > b.x2), strict=True)]
    todo = stash(t.join(ends, key).withColumn("open", F.array_compact(F.array(*has))).where(F.size("open") > 0).drop("_h1", "_h2", "_v1", "_v2"), "todo")
    h = F.col("axis") == "h"
    across_lo, across_hi = F.when(h, b.y1).otherwise(b.x1), F.when(h, b.y2).otherwise(b.x2)
    along_lo, along_hi = F.when(h, b.x1).otherwise(b.y1), F.when(h, b.x2).otherwise(b.y2)
    away = F.hypot(F.greatest(across_lo - F.col("level"), F.col("level") - across_hi, g.zero()), F.greatest(along_lo - F.col("hi"), F.col("lo") - along_hi, g.zero()))
    mid = (F.col("lo") + F.col("hi")) / 2
    side = F.when(F.col("level") < across_lo, F.when(h, "above").otherwise("left")).when(F.col("level") > across_hi, F.when(h, "below").otherwise("right"))
    row = F.struct(F.col("_d").alias("d"), "line_ix", "level", F.when(h, mid).otherwise(F.col("level")).alias("mid_x"), F.when(h, F.col("level")).otherwise(mid).alias("mid_y"))
    place = (F.when(h, F.col("lo")).otherwise(F.col("level")), F.when(h, F.col("level")).otherwise(F.col("lo")), F.when(h, F.col("hi")).otherwise(F.col("level")), F.when(h, F.col("level")).otherwise(F.col("hi")))
    reach, done = first, []
    while True:
        met = box_join(todo, l, key, tuple(b), place, reach, 2 * reach).withColumns({"_side": side, "_d": away}).where((F.col("_d") <= reach) & F.array_contains("open", F.col("_side")))
        near = stash(met.groupBy(*key, "text_ix").agg(*[F.min(F.when(F.col("_side") == n, row)).alias(n) for n in names]), "ring")
        done.append(near)
        found = near.select(*key, "text_ix", F.array_compact(F.array(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in names])).alias("_f"))
        rest = todo.join(found, [*key, "text_ix"], "left").withColumn("open", F.when(F.col("_f").isNull(), F.col("open")).otherwise(F.array_except("open", "_f"))).drop("_f").where(F.size("open") > 0)
        rest = stash(rest, "todo")
        drop_stash(todo)
        todo = rest
        if todo.isEmpty():
            break
        reach *= 4
    drop_stash(todo)
    rings = done[0]
    for more in done[1:]:
        rings = rings.unionByName(more)
    wide = rings.groupBy(*key, "text_ix").agg(*[F.min(n).alias(n) for n in names])  # each side was found in one ring
    return texts.join(wide, [*key, "text_ix"], "left")


def crop(sided: DataFrame, width: int, height: int, padding: int = 8, least: int = 24, mode: str = "bounds") -> DataFrame:
    """sided with crop x1..y2 (cx1..cy2), sides_found and contains_text; texts without a side, or with too small a crop, go."""
    four = [F.col(c) for c in ("above", "below", "left", "right")]
    found = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in four), F.lit(0))
    b = g.box()
    if mode == "bounds":
        edges = (F.least(b.x1, F.col("left.level")), F.least(b.y1, F.col("above.level")), F.greatest(b.x2, F.col("right.level")), F.greatest(b.y2, F.col("below.level")))
    else:
        pick = lambda agg, own, part: F.coalesce(agg(*[F.col(f"{c}.{part}") for c in own]), agg(*[F.col(f"{c}.{part}") for c in ("above", "below", "left", "right")]))
        edges = (pick(F.least, ("left", "right"), "mid_x"), pick(F.least, ("above", "below"), "mid_y"), pick(F.greatest, ("left", "right"), "mid_x"), pick(F.greatest, ("above", "below"), "mid_y"))
    whole = lambda c: c.cast("int")
    out = sided.withColumn("sides_found", found).where("sides_found > 0").withColumns({"cx1": F.greatest(F.lit(0), whole(edges[0]) - padding), "cy1": F.greatest(F.lit(0), whole(edges[1]) - padding), "cx2": F.least(F.lit(width), whole(edges[2]) + padding), "cy2": F.least(F.lit(height), whole(edges[3]) + padding)})
    inner: Column = (F.col("cx1") <= b.x1) & (F.col("cy1") <= b.y1) & (b.x2 <= F.col("cx2")) & (b.y2 <= F.col("cy2"))
    return out.where((F.col("cx2") - F.col("cx1") >= least) & (F.col("cy2") - F.col("cy1") >= least)).withColumn("contains_text", inner)
