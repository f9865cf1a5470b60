"""Preparing detected segments: boxed marks, dashes, chains of collinear pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetgraph.functions import geometry as g
from sheetgraph.operators.greedy import keep_greedily
from sheetgraph.operators.spatial import box_join


def mark_boxed(lines: DataFrame, boxes: DataFrame, key: list[str], line: str = "line_ix", cell: float = 200.0) -> DataFrame:
    """lines (x1, y1, x2, y2) with `boxed`: both ends lie in one box (x1, y1, x2, y2), and with it all between."""
    start = lines.select(*key, line, *[F.col(c).alias(f"_s{c}") for c in ("x1", "y1", "x2", "y2")])
    b = boxes.select(*key, *[F.col(c).alias(f"_q{c}") for c in ("x1", "y1", "x2", "y2")])
    q = g.box("_q")
    met = box_join(start, b, key, (F.col("_sx1"), F.col("_sy1"), F.col("_sx1"), F.col("_sy1")), tuple(q), 0.0, cell)
    s = g.box("_s")
    hit = met.where(g.inside(g.bounds(s), q)).select(*key, line).distinct().withColumn("boxed", F.lit(True))
    return lines.join(hit, [*key, line], "left").withColumn("boxed", F.coalesce("boxed", F.lit(False)))


def outside_texts(lines: DataFrame, texts: DataFrame, key: list[str], line: str = "line_ix", cell: float = 200.0) -> DataFrame:
    """lines whose surrounding box touches no text's box."""
    b = g.bounds(g.box())
    a = lines.select(*key, line, *[c.alias(f"_s{n}") for c, n in zip(b, ("x1", "y1", "x2", "y2"), strict=True)])
    t = texts.select(*key, *[F.col(c).alias(f"_q{c}") for c in ("x1", "y1", "x2", "y2")])
    met = box_join(a, t, key, tuple(g.box("_s")), tuple(g.box("_q")), 0.0, cell)
    return lines.join(met.select(*key, line).distinct(), [*key, line], "left_anti")


def duplicate_pairs(lines: DataFrame, key: list[str], line: str = "line_ix", angle: float = 10.0, across: float = 5.0, share: float = 0.25, cell: float = 200.0) -> DataFrame:
    """(earlier, later) of segments (x1, y1, x2, y2): the later one may lie on the earlier one's stroke.

    Earlier is the longer, then the smaller `line`. The directions differ by at most `angle`
    degrees, both ends of the later one lie within `across` of the earlier one's line, and their
    extents along it share at least `share` of the shorter one. Lengths of zero have no stroke.
    """
    side = lambda p, n: lines.select(*key, F.col(line).alias(n), *[F.col(c).cast("double").alias(f"_{p}_{c}") for c in ("x1", "y1", "x2", "y2")])
    k, c = g.box("_k_"), g.box("_c_")
    met = box_join(side("k", "earlier"), side("c", "later"), key, tuple(g.bounds(k)), tuple(g.bounds(c)), 1.5 * across, cell)
    met = met.withColumns({f"_{p}n": F.hypot(b.x2 - b.x1, b.y2 - b.y1) for p, b in (("k", k), ("c", c))})
    first = (F.col("_kn") > F.col("_cn")) | ((F.col("_kn") == F.col("_cn")) & (F.col("earlier") < F.col("later")))
    met = met.where(first & (F.col("_cn") > 0)).withColumns({"_ux": (k.x2 - k.x1) / F.col("_kn"), "_uy": (k.y2 - k.y1) / F.col("_kn")})
    off = lambda x, y: F.abs((x - k.x1) * F.col("_uy") - (y - k.y1) * F.col("_ux"))
    along = lambda x, y: (x - k.x1) * F.col("_ux") + (y - k.y1) * F.col("_uy")
    a, b = along(c.x1, c.y1), along(c.x2, c.y2)
    shared = F.least(F.col("_kn"), F.greatest(a, b)) - F.greatest(g.zero(), F.least(a, b))
    turn = lambda s: F.pmod(F.degrees(F.atan2(s.y2 - s.y1, s.x2 - s.x1)), F.lit(180.0))
    gap = F.abs(turn(k) - turn(c))
    same = (F.least(gap, 180 - gap) <= angle) & (off(c.x1, c.y1) <= across) & (off(c.x2, c.y2) <= across) & (shared / F.col("_cn") >= share)
    return met.where(same).select(*key, "earlier", "later")


def deduplicated(lines: DataFrame, key: list[str], line: str = "line_ix", **tolerances) -> DataFrame:
    """The longest segment of each stroke: a scan, longest first, leaves out what lies on a segment kept before."""
    return keep_greedily(lines, duplicate_pairs(lines, key, line, **tolerances), key, line)


def variation(values: Column) -> Column:
    """Population deviation over mean of a set of rows: 0 below two rows, infinite for mean 0."""
    return F.when(F.count(values) < 2, F.lit(0.0)).when(F.avg(values) == 0, F.lit(g.INF)).otherwise(F.try_divide(F.stddev_pop(values), F.avg(values)))


def stroke_runs(profile: DataFrame, key: list[str], at: str, ink: str) -> DataFrame:
    """Run-length encoding of a profile: (key, first, ink, length)."""
    w = Window.partitionBy(*key).orderBy(at)
    change = F.when(F.coalesce(F.lag(ink).over(w) == F.col(ink), F.lit(False)), 0).otherwise(1)
    return profile.withColumn("_c", change).withColumn("_r", F.sum("_c").over(w)).groupBy(*key, "_r", ink).agg(F.min(at).alias("first"), F.count("*").alias("length")).drop("_r")


def dash_chunks(runs: DataFrame, key: list[str], blank: float = 25.0) -> DataFrame:
    """Stroke runs with the number of their chunk, without each chunk's first and last run; blanks over `blank` part chunks."""
    w = Window.partitionBy(*key).orderBy("first")
    wide = (~F.col("ink")) & (F.col("length") > blank)
    c = runs.withColumn("chunk", F.sum(F.when(wide, 1).otherwise(0)).over(w)).where(~wide)
    v = Window.partitionBy(*key, "chunk")
    edge = c.withColumns({"_lo": F.min("first").over(v), "_hi": F.max("first").over(v)})
    return edge.where((F.col("first") > F.col("_lo")) & (F.col("first") < F.col("_hi"))).drop("_lo", "_hi")


#: Fixed values, in pixels of a sheet 3916 wide: least and most length of a gap and of a dash.
DASH_LIMITS = {"gap_px": (2, 25), "dash_px": (4, 60)}


def dash_verdicts(inner: DataFrame, key: list[str], limits: dict[str, tuple[float, float]] = DASH_LIMITS) -> DataFrame:
    """dash, gap, period and dashed of each chunk of inner stroke runs."""
    gap, dash = F.when(~F.col("ink"), F.col("length")), F.when(F.col("ink"), F.col("length"))
    a = inner.groupBy(*key, "chunk").agg(F.count(gap).alias("gaps"), F.median(gap).alias("gap"), F.median(dash).alias("dash"), variation(gap).alias("gap_cv"), variation(dash).alias("dash_cv"))
    fits = (F.col("gaps") >= 2) & F.col("gap").between(*limits["gap_px"]) & F.col("dash").between(*limits["dash_px"]) & (F.col("gap_cv") < 0.45) & (F.col("dash_cv") < 0.45)
    return a.withColumn("period", F.col("dash") + F.col("gap")).withColumn("dashed", F.coalesce(fits, F.lit(False)))


def anchored_clusters(values: Column, tolerance: float) -> Column:
    """Starts of the clusters of an array of numbers: a value over `tolerance` beyond its cluster's first starts another."""
    first = F.array().cast("array<double>")
    return F.aggregate(F.array_sort(values.cast("array<double>")), first, lambda acc, x: F.when((F.size(acc) == 0) | (x - F.element_at(acc, F.when(F.size(acc) == 0, 1).otherwise(-1)) > tolerance), F.array_append(acc, x)).otherwise(acc))


def bridged(pieces: DataFrame, key: list[str], most_gap: float = 600.0, most_crossings: int = 2) -> DataFrame:
    """Collinear pieces (lo, hi, evidence, crossings to the next) of a key joined over gaps.

    A gap is bridged if it is at most most_gap, carries evidence and has at most
    most_crossings crossings; pieces that touch or overlap always join. The end that counts
    is that of the whole chain so far, so this is a fold in order of lo.
    """
    item = F.struct(F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi"), F.col("evidence"), F.col("crossings").cast("int").alias("crossings"))
    empty = F.array().cast("array<struct<lo:double,hi:double,pieces:int>>")

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, F.when(F.size(acc) == 0, 1).otherwise(-1))
        gap = x["lo"] - last["hi"]
        ok = (gap <= 0) | ((gap <= most_gap) & x["evidence"] & (x["crossings"] <= most_crossings))
        new = F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), F.lit(1).alias("pieces"))
        grown = F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], x["hi"]).alias("hi"), (last["pieces"] + 1).alias("pieces"))
        return F.when(F.size(acc) == 0, F.array(new)).when(ok, F.array_append(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), grown)).otherwise(F.array_append(acc, new))

    return pieces.groupBy(*key).agg(F.sort_array(F.collect_list(item)).alias("_p")).select(*key, F.inline(F.aggregate("_p", empty, step)))


def crossing_counts(gaps: DataFrame, uprights: DataFrame, key: list[str], cell: float = 200.0) -> DataFrame:
    """gaps (gap_id, level, lo, hi) with `crossings`: perpendicular runs (pos, lo, hi) strictly within it that span its level."""
    a = gaps.select(*key, "gap_id", F.col("level").alias("_lv"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    b = uprights.select(*key, F.col("pos").alias("_p"), F.col("lo").alias("_a"), F.col("hi").alias("_b"))
    met = box_join(a, b, key, (F.col("_lo"), F.col("_lv"), F.col("_hi"), F.col("_lv")), (F.col("_p"), F.col("_a"), F.col("_p"), F.col("_b")), 0.0, cell).where("_p > _lo and _p < _hi and _lv between _a and _b")
    return gaps.join(met.groupBy(*key, "gap_id").agg(F.count("*").alias("crossings")), [*key, "gap_id"], "left").withColumn("crossings", F.coalesce("crossings", F.lit(0)))
