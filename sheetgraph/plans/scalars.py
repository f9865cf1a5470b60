"""Queries of the projections and filters: coordinates, boxes, segments and distances."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetgraph.functions import geometry as g
from sheetgraph.plans.registry import query
from sheetgraph.sources import derived as d

W, H = float(d.WIDTH), float(d.HEIGHT)
A, B = g.NamedBox("a"), g.NamedBox("b")


def r(c, digits: int = 6):
    return F.round(c, digits)


def named(b: g.Box, prefix: str = ""):
    return [r(c).alias(f"{prefix}{n}") for c, n in zip(b, ("x1", "y1", "x2", "y2"), strict=True)]


@query("p01_to_pixels", "select sheet_id, symbol_id, cast(trunc(x1/4000.0*777) as int) as px, cast(trunc(y1/3000.0*555) as int) as py from symbols")
def p01(spark, sf):
    s = d.normalized(d.symbols(spark, sf))
    return s.select("sheet_id", "symbol_id", g.to_pixels(F.col("x1"), 777.0).alias("px"), g.to_pixels(F.col("y1"), 555.0).alias("py"))


@query("p02_to_fraction", "select sheet_id, symbol_id, round(x1/4000.0,6) as x1, round(y1/3000.0,6) as y1, round(x2/4000.0,6) as x2, round(y2/3000.0,6) as y2 from symbols")
def p02(spark, sf):
    b = g.box()
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", *named(g.Box(g.to_fraction(b.x1, W), g.to_fraction(b.y1, H), g.to_fraction(b.x2, W), g.to_fraction(b.y2, H))))


@query("p03_clamped_fraction", "select sheet_id, a_id, round(greatest(0.0,least(1.0,ax1/4000.0)),6) as x1, round(greatest(0.0,least(1.0,ay2/3000.0)),6) as y2 from pairs")
def p03(spark, sf):
    return d.pairs(spark, sf).select("sheet_id", "a_id", r(g.clamped_fraction(A.x1, W)).alias("x1"), r(g.clamped_fraction(A.y2, H)).alias("y2"))


@query("p04_threshold_fraction", "select o_orderkey, round(50.0/greatest(o_custkey+1, o_orderkey+1),9) as lines, round(12.0/greatest(o_custkey+1, o_orderkey+1),9) as symbols from orders", views=False)
def p04(spark, sf):
    w, h = (F.col("o_custkey") + 1).cast("double"), (F.col("o_orderkey") + 1).cast("double")
    return d.base(spark, sf, "orders").select("o_orderkey", r(g.threshold_fraction(50, w, h), 9).alias("lines"), r(g.threshold_fraction(12, w, h), 9).alias("symbols"))


@query("p05_valid_box", "select sheet_id, a_id, (ax1 between 0 and 4000 and ax2 between 0 and 4000 and ay1 between 0 and 3000 and ay2 between 0 and 3000 and ax1<=ax2 and ay1<=ay2) as ok from pairs")
def p05(spark, sf):
    b = g.Box(A.x1 / W, A.y1 / H, A.x2 / W, A.y2 / H)
    return d.pairs(spark, sf).select("sheet_id", "a_id", g.valid_fraction(b).alias("ok"))


@query("p06_corners", "select sheet_id, symbol_id, 0 as k, x1 as x, y1 as y from symbols union all select sheet_id, symbol_id, 1, x2, y1 from symbols union all select sheet_id, symbol_id, 2, x2, y2 from symbols union all select sheet_id, symbol_id, 3, x1, y2 from symbols")
def p06(spark, sf):
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", F.posexplode(g.corners(g.box())).alias("k", "p")).select("sheet_id", "symbol_id", "k", "p.x", "p.y")


@query("p07_sides", "select sheet_id, symbol_id, 'top' as side, x1, y1, x2, y1 as y2 from symbols union all select sheet_id, symbol_id, 'right', x2, y1, x2, y2 from symbols union all select sheet_id, symbol_id, 'bottom', x2, y2, x1, y2 from symbols union all select sheet_id, symbol_id, 'left', x1, y2, x1, y1 from symbols")
def p07(spark, sf):
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", F.inline(g.sides(g.box())))


@query("p08_segment_length", "select sheet_id, line_ix, round(sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)),6) as length from lines")
def p08(spark, sf):
    return d.lines(spark, sf).select("sheet_id", "line_ix", r(g.length(g.box())).alias("length"))


_O = "greatest(0, least(ax2,bx2)-greatest(ax1,bx1))*greatest(0, least(ay2,by2)-greatest(ay1,by1))"
_AA, _AB = "((ax2-ax1)*(ay2-ay1))", "((bx2-bx1)*(by2-by1))"


@query("p09_iou", f"select sheet_id, a_id, b_id, round(o/({_AA}+{_AB}-o),6) as iou from (select *, {_O} as o from pairs)")
def p09(spark, sf):
    return d.pairs(spark, sf).select("sheet_id", "a_id", "b_id", r(g.iou(A, B)).alias("iou"))


@query("p10_overlap_of_smaller", f"select sheet_id, a_id, b_id, round({_O}/least({_AA},{_AB}),6) as share from pairs")
def p10(spark, sf):
    return d.pairs(spark, sf).select("sheet_id", "a_id", "b_id", r(g.overlap_of_smaller(A, B)).alias("share"))


@query("p11_contained_share", f"select sheet_id, a_id, b_id, round({_O}/{_AB},6) as share from pairs")
def p11(spark, sf):
    return d.pairs(spark, sf).select("sheet_id", "a_id", "b_id", r(g.contained_share(B, A)).alias("share"))


@query("p12_overlap_area", f"select sheet_id, a_id, b_id, cast({_O} as double) as area from pairs")
def p12(spark, sf):
    return d.pairs(spark, sf).select("sheet_id", "a_id", "b_id", g.overlap_area(A, B).alias("area"))


@query("p13_overlaps_more_than", f"select sheet_id, a_id, b_id, {_O}/{_AA} > 0.25 as hit from pairs")
def p13(spark, sf):
    return d.pairs(spark, sf).select("sheet_id", "a_id", "b_id", g.overlaps_more_than(A, B, 0.25).alias("hit"))


@query("p14_box_gap", "select sheet_id, a_id, b_id, round(sqrt(pow(greatest(ax1-bx2,bx1-ax2,0),2)+pow(greatest(ay1-by2,by1-ay2,0),2)),6) as gap from pairs")
def p14(spark, sf):
    return d.pairs(spark, sf).select("sheet_id", "a_id", "b_id", r(g.gap(A, B)).alias("gap"))


@query("p15_inside", "select sheet_id, a_id, b_id, (bx1>=ax1 and by1>=ay1 and bx2<=ax2 and by2<=ay2) as plain, (bx1>=ax1-2 and by1>=ay1-2 and bx2<=ax2+2 and by2<=ay2+2) as slack from pairs")
def p15(spark, sf):
    return d.pairs(spark, sf).select("sheet_id", "a_id", "b_id", g.inside(B, A).alias("plain"), g.inside(B, A, 2.0).alias("slack"))


@query("p16_segment_bounds", "select sheet_id, line_ix, least(x1,x2) as x1, least(y1,y2) as y1, greatest(x1,x2) as x2, greatest(y1,y2) as y2 from lines")
def p16(spark, sf):
    return d.lines(spark, sf).select("sheet_id", "line_ix", *[c.alias(n) for c, n in zip(g.bounds(g.box()), ("x1", "y1", "x2", "y2"), strict=True)])


@query("p17_inside_or_unbounded", "select sheet_id, symbol_id, case when sheet_id % 2 = 0 then true else x1>=100 and y1>=100 and x2<=2500 and y2<=2000 end as ok from symbols")
def p17(spark, sf):
    even = F.col("sheet_id") % 2 == 0
    outer = g.Box(*[F.when(~even, F.lit(v)) for v in (100, 100, 2500, 2000)])
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", g.inside_or_unbounded(g.box(), outer).alias("ok"))


@query("p18_axis_overlap", "select sheet_id, a_id, b_id, (ox>=0 and (ox>=0.7*(ax2-ax1) or ox>=0.7*(bx2-bx1))) as along_x, (oy>=0 and (oy>=0.7*(ay2-ay1) or oy>=0.7*(by2-by1))) as along_y from (select *, least(ax2,bx2)-greatest(ax1,bx1) as ox, least(ay2,by2)-greatest(ay1,by1) as oy from pairs)")
def p18(spark, sf):
    return d.pairs(spark, sf).select("sheet_id", "a_id", "b_id", g.axis_overlap(A, B, "h", 0.7).alias("along_x"), g.axis_overlap(A, B, "v", 0.7).alias("along_y"))


@query("p19_padded", "select sheet_id, a_id, ax1-5 as hx1, ax2+5 as hx2, ay1-5 as vy1, ay2+5 as vy2 from pairs")
def p19(spark, sf):
    h, v = g.padded(A, 10, "h"), g.padded(A, 10, "v")
    return d.pairs(spark, sf).select("sheet_id", "a_id", h.x1.alias("hx1"), h.x2.alias("hx2"), v.y1.alias("vy1"), v.y2.alias("vy2"))


@query("p20_slope", "select sheet_id, line_ix, case when x1=x2 then cast('inf' as double) else round((y2-y1)/(x2-x1),6) end as slope from lines where not (x1=x2 and y1=y2)")
def p20(spark, sf):
    return d.lines(spark, sf).where("not (x1 = x2 and y1 = y2)").select("sheet_id", "line_ix", r(g.slope(g.box())).alias("slope"))


@query("p21_angles", "select sheet_id, line_ix, round(a,6) as angle, round(least(abs(a-75),180-abs(a-75)),6) as gap from (select *, fmod(degrees(atan2(y2-y1,x2-x1))+180,180) as a from lines)")
def p21(spark, sf):
    a = g.folded_angle(g.box())
    return d.lines(spark, sf).select("sheet_id", "line_ix", r(a).alias("angle"), r(g.angle_gap(a, F.lit(75.0))).alias("gap"))


@query("p22_pixel_ends", "select sheet_id, line_ix, cast(round(x1,3) as double) as x1, cast(round(y2,3) as double) as y2 from lines")
def p22(spark, sf):
    n = d.normalized(d.lines(spark, sf))
    return n.select("sheet_id", "line_ix", r(F.col("x1") * W, 3).alias("x1"), r(F.col("y2") * H, 3).alias("y2"))


@query("p23_orientation", "select sheet_id, line_ix, case when x1=x2 and y1=y2 then null when a<=5 then 'h' when a>=85 then 'v' end as axis from (select *, degrees(atan2(abs(y2-y1),abs(x2-x1))) as a from lines)")
def p23(spark, sf):
    return d.lines(spark, sf).select("sheet_id", "line_ix", g.orientation(g.box(), 5.0).alias("axis"))


@query("p24_snapped", "select sheet_id, line_ix, case when a<=10 then 'h' else 'v' end as axis, cast(case when a<=10 then floor((y1+y2)/2) else floor((x1+x2)/2) end as bigint) as level, cast(case when a<=10 then least(x1,x2) else least(y1,y2) end as bigint) as lo, cast(case when a<=10 then greatest(x1,x2) else greatest(y1,y2) end as bigint) as hi from (select *, least(abs(degrees(atan2(y2-y1,x2-x1))), 180-abs(degrees(atan2(y2-y1,x2-x1)))) as a from lines) where a<=10 or a>=80")
def p24(spark, sf):
    s = d.lines(spark, sf).withColumn("s", g.snapped(g.box(), 10.0)).where("s is not null")
    return s.select("sheet_id", "line_ix", "s.axis", "s.level", "s.lo", "s.hi")


@query("p25_ray_box", """select sheet_id, a_id, b_id, round(case when cy < by1 or cy > by2 or bx2 < ax2 then null else greatest(bx1-ax2,0) end,6) as right_, round(case when greatest((bx1-cx)/0.8,(by1-cy)/0.6) > least((bx2-cx)/0.8,(by2-cy)/0.6) or least((bx2-cx)/0.8,(by2-cy)/0.6) < 0 then null else greatest(0,(bx1-cx)/0.8,(by1-cy)/0.6) end,6) as down
from (select *, (ax1+ax2)/2 as cx, (ay1+ay2)/2 as cy from pairs)""")
def p25(spark, sf):
    cx, cy = g.centre(A)
    return d.pairs(spark, sf).select("sheet_id", "a_id", "b_id", r(g.ray_box(A.x2, cy, F.lit(1.0), F.lit(0.0), B)).alias("right_"), r(g.ray_box(cx, cy, F.lit(0.8), F.lit(0.6), B)).alias("down"))


@query("p26_rescaled", "select o_orderkey, cast(round_even(o_custkey/1.8,0) as int) as x from orders", views=False)
def p26(spark, sf):
    return d.base(spark, sf, "orders").select("o_orderkey", g.rescaled(F.col("o_custkey").cast("double"), 1.8).alias("x"))


@query("p27_expanded", "select sheet_id, symbol_id, x1-20 as x1, y1-20 as y1, x2+20 as x2, y2+20 as y2 from symbols")
def p27(spark, sf):
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", *[c.cast("long").alias(n) for c, n in zip(g.expanded(g.box(), 20), ("x1", "y1", "x2", "y2"), strict=True)])


@query("p28_moved", "select sheet_id, symbol_id, x1+640*(sheet_id%4)-8 as x1, y1+480*(sheet_id%3)-8 as y1, x2+640*(sheet_id%4)-8 as x2, y2+480*(sheet_id%3)-8 as y2 from symbols")
def p28(spark, sf):
    m = g.moved(g.box(), 640 * (F.col("sheet_id") % 4) - 8, 480 * (F.col("sheet_id") % 3) - 8)
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", *[c.alias(n) for c, n in zip(m, ("x1", "y1", "x2", "y2"), strict=True)])


_NEXT = "select l.sheet_id, l.line_ix, l.x1 as sx1, l.y1 as sy1, l.x2 as sx2, l.y2 as sy2, cast(s.x1 as double) as bx1, cast(s.y1 as double) as by1, cast(s.x2 as double) as bx2, cast(s.y2 as double) as by2 from lines l join symbols s on l.sheet_id = s.sheet_id and s.symbol_id = 500*l.sheet_id + l.line_ix % 500"


def _line_symbol(spark, sf):
    l, s = d.lines(spark, sf).select("sheet_id", "line_ix", *[F.col(c).alias(f"s{c}") for c in ("x1", "y1", "x2", "y2")]), d.symbols(spark, sf)
    l = l.withColumn("symbol_id", 500 * F.col("sheet_id") + F.col("line_ix") % 500)
    return l.join(s.select("sheet_id", "symbol_id", *[F.col(c).cast("double").alias(f"b{c}") for c in ("x1", "y1", "x2", "y2")]), ["sheet_id", "symbol_id"])


def _connector(name, left, right, top, bottom):
    case = lambda k: "case when sx1<bx1 then {} when sx2>bx2 then {} when sy1<by1 then {} else {} end".format(*[x.split("|")[k] for x in (left, right, top, bottom)])
    return query(name, f"select sheet_id, line_ix, {', '.join(f'{case(k)} as {c}' for k, c in enumerate(('x1', 'y1', 'x2', 'y2')))} from ({_NEXT})")


@_connector("p29_text_connector", "sx2|sy2|sx2+bx2-bx1|sy2", "sx1-(bx2-bx1)|sy1|sx1|sy1", "sx2|sy2|sx2|sy2+by2-by1", "sx1|sy1-(by2-by1)|sx1|sy1")
def p29(spark, sf):
    return _line_symbol(spark, sf).select("sheet_id", "line_ix", g.text_connector(g.box("b"), g.box("s")).alias("c")).select("sheet_id", "line_ix", "c.*")


@_connector("p30_symbol_connector", "sx2|sy2|bx1|sy2", "bx2|sy1|sx1|sy1", "sx2|sy2|sx2|by1", "sx1|by2|sx1|sy1")
def p30(spark, sf):
    return _line_symbol(spark, sf).select("sheet_id", "line_ix", g.symbol_connector(g.box("b"), g.box("s")).alias("c")).select("sheet_id", "line_ix", "c.*")


_PT = "sqrt(pow({px}-({x1}+{t}*({x2}-{x1})),2)+pow({py}-({y1}+{t}*({y2}-{y1})),2))"


def _pt(px, py, s):
    x1, y1, x2, y2 = (f"{s}{c}" for c in ("x1", "y1", "x2", "y2"))
    n = f"(({x2}-{x1})*({x2}-{x1})+({y2}-{y1})*({y2}-{y1}))"
    t = f"(case when {n}=0 then 0 else greatest(0,least(1,(({px}-{x1})*({x2}-{x1})+({py}-{y1})*({y2}-{y1}))/{n})) end)"
    return _PT.format(px=px, py=py, x1=x1, y1=y1, x2=x2, y2=y2, t=t)


_TWO = "select a.sheet_id, a.line_ix, a.x1 as ax1, a.y1 as ay1, a.x2 as ax2, a.y2 as ay2, b.x1 as bx1, b.y1 as by1, b.x2 as bx2, b.y2 as by2 from lines a join lines b on a.sheet_id=b.sheet_id and b.line_ix=a.line_ix+1"


def _two_lines(spark, sf):
    l = d.lines(spark, sf)
    a = l.select("sheet_id", "line_ix", *[F.col(c).alias(f"a{c}") for c in ("x1", "y1", "x2", "y2")])
    b = l.select("sheet_id", (F.col("line_ix") - 1).alias("line_ix"), *[F.col(c).alias(f"b{c}") for c in ("x1", "y1", "x2", "y2")])
    return a.join(b, ["sheet_id", "line_ix"])


@query("p31_line_connector", f"""select sheet_id, line_ix, case when turn then qx else px end as x1, case when turn then qy else py end as y1, case when turn then px else qx end as x2, case when turn then py else qy end as y2 from
(select *, px>qx or (px=qx and py>qy) as turn from (select sheet_id, line_ix, case when p then ax1 else ax2 end as px, case when p then ay1 else ay2 end as py, case when q then bx1 else bx2 end as qx, case when q then by1 else by2 end as qy from
(select *, {_pt("ax1", "ay1", "b")} < {_pt("ax2", "ay2", "b")} as p, {_pt("bx1", "by1", "a")} < {_pt("bx2", "by2", "a")} as q from ({_TWO}))))""")
def p31(spark, sf):
    return _two_lines(spark, sf).select("sheet_id", "line_ix", g.line_connector(A, B).alias("c")).select("sheet_id", "line_ix", "c.*")


@query("p32_centre_connector", "select sheet_id, a_id, b_id, (ax1+ax2)/2 as x1, (ay1+ay2)/2 as y1, (bx1+bx2)/2 as x2, (by1+by2)/2 as y2 from pairs")
def p32(spark, sf):
    return d.pairs(spark, sf).select("sheet_id", "a_id", "b_id", *[c.alias(n) for c, n in zip(g.centre_connector(A, B), ("x1", "y1", "x2", "y2"), strict=True)])


_CROSS = "((bx2-bx1)*(ay1-by1)-(by2-by1)*(ax1-bx1))*((bx2-bx1)*(ay2-by1)-(by2-by1)*(ax2-bx1))<0 and ((ax2-ax1)*(by1-ay1)-(ay2-ay1)*(bx1-ax1))*((ax2-ax1)*(by2-ay1)-(ay2-ay1)*(bx2-ax1))<0"


@query("p33_distances", f"select sheet_id, line_ix, round({_pt('ax1', 'ay1', 'b')},4) as point_line, round(case when {_CROSS} then 0 else least({_pt('ax1', 'ay1', 'b')},{_pt('ax2', 'ay2', 'b')},{_pt('bx1', 'by1', 'a')},{_pt('bx2', 'by2', 'a')}) end,4) as line_line from ({_TWO})")
def p33(spark, sf):
    return _two_lines(spark, sf).select("sheet_id", "line_ix", r(g.point_segment(A.x1, A.y1, B), 4).alias("point_line"), r(g.segment_segment(A, B), 4).alias("line_line"))


# --- filters


@query("f01_text_in_main_box", "select sheet_id, text_ix from texts where sheet_id % 2 = 0 or (x1>=100 and y1>=100 and x2<=2500 and y2<=2000)")
def f01(spark, sf):
    even = F.col("sheet_id") % 2 == 0
    outer = g.Box(*[F.when(~even, F.lit(v)) for v in (100, 100, 2500, 2000)])
    return d.texts(spark, sf).where(g.inside_or_unbounded(g.box(), outer)).select("sheet_id", "text_ix")


@query("f02_segment_in_main_box", "select sheet_id, line_ix from lines where x1>=100 and y1>=100 and x2<=2500 and y2<=2000")
def f02(spark, sf):
    return d.lines(spark, sf).where("x1 >= 100 and y1 >= 100 and x2 <= 2500 and y2 <= 2000").select("sheet_id", "line_ix")


@query("f03_axis_aligned", "select sheet_id, line_ix from lines where not (x1=x2 and y1=y2) and (degrees(atan2(abs(y2-y1),abs(x2-x1)))<=5 or degrees(atan2(abs(y2-y1),abs(x2-x1)))>=85)")
def f03(spark, sf):
    return d.lines(spark, sf).where(g.orientation(g.box(), 5.0).isNotNull()).select("sheet_id", "line_ix")


@query("f06_label_excluded", "select sheet_id, symbol_id from symbols where not contains(label,'Mid arrow') and not contains(label,'Panel')")
def f06(spark, sf):
    banned = F.lit(False)
    for part in ("Mid arrow", "Panel"):
        banned = banned | F.contains("label", F.lit(part))
    return d.symbols(spark, sf).where(~banned).select("sheet_id", "symbol_id")


@query("f08_centre_in_region", "select sheet_id, symbol_id from symbols where (x1+x2)/2.0>=500 and (x1+x2)/2.0<2000 and (y1+y2)/2.0>=200 and (y1+y2)/2.0<1500")
def f08(spark, sf):
    cx, cy = g.centre(g.box())
    return d.symbols(spark, sf).where((cx >= 500) & (cx < 2000) & (cy >= 200) & (cy < 1500)).select("sheet_id", "symbol_id")


@query("f10_minimum_length", "select sheet_id, line_ix from segments where hi - lo >= 60")
def f10(spark, sf):
    return d.segments(spark, sf).where("hi - lo >= 60").select("sheet_id", "line_ix")


@query("f15_undirected_pairs", "select distinct sheet_id, least(a,b) as a, greatest(a,b) as b from (select sheet_id, a_id as a, b_id as b from pairs union all select sheet_id, b_id, a_id from pairs) where a<>b")
def f15(spark, sf):
    p = d.pairs(spark, sf)
    both = p.select("sheet_id", F.col("a_id").alias("a"), F.col("b_id").alias("b")).union(p.select("sheet_id", "b_id", "a_id"))
    return both.where("a <> b").select("sheet_id", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


@query("f16_symbol_lookup", "select sheet_id, symbol_id, 'tag' as by_ from symbols where upper(trim(text_associated))='V12' union all select sheet_id, symbol_id, 'id' from symbols where symbol_id=300 union all select sheet_id, symbol_id, 'label' from symbols where contains(lower(label),'vessel')")
def f16(spark, sf):
    s = d.symbols(spark, sf)
    rules = [("tag", F.upper(F.trim("text_associated")) == "V12"), ("id", F.col("symbol_id") == 300), ("label", F.contains(F.lower("label"), F.lit("vessel")))]
    hit = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules]))
    return s.select("sheet_id", "symbol_id", F.explode(hit).alias("by_"))


# --- line preparation


#: Half-even rounding of a double's shortest decimal form, as the extension has it.
_ROUND5 = "cast(round_even(cast(cast({} as varchar) as decimal(30,20)),5) as double)"


@query("l01_extended", f"select sheet_id, line_ix, x1=x2 as upright, {_ROUND5.format('case when x1=x2 then x1 else greatest(x1-0.2,0) end')} as x1, {_ROUND5.format('case when x1=x2 then x2 else least(x2+0.2,1) end')} as x2, {_ROUND5.format('case when x1=x2 then greatest(y1-0.2,0) else y1+coalesce((y2-y1)/nullif(x2-x1,0),0)*(greatest(x1-0.2,0)-x1) end')} as y1 from (select sheet_id, line_ix, x1/4000.0 as x1, y1/3000.0 as y1, x2/4000.0 as x2, y2/3000.0 as y2 from lines)")
def l01(spark, sf):
    e = g.extended(g.box(), 0.2)
    return d.normalized(d.lines(spark, sf)).select("sheet_id", "line_ix", (F.col("x1") == F.col("x2")).alias("upright"), e.x1.alias("x1"), e.x2.alias("x2"), e.y1.alias("y1"))


@query("l02_ordered_ends", "select sheet_id, line_ix, case when t then x2 else x1 end as x1, case when t then y2 else y1 end as y1, case when t then x1 else x2 end as x2, case when t then y1 else y2 end as y2 from (select *, x1>x2 or (x1=x2 and y1>y2) as t from (select sheet_id, line_ix, case when line_ix%2=0 then x2 else x1 end as x1, case when line_ix%2=0 then y2 else y1 end as y1, case when line_ix%2=0 then x1 else x2 end as x2, case when line_ix%2=0 then y1 else y2 end as y2 from lines))")
def l02(spark, sf):
    even = F.col("line_ix") % 2 == 0
    swap = lambda a, b: F.when(even, F.col(b)).otherwise(F.col(a))
    s = d.lines(spark, sf).select("sheet_id", "line_ix", swap("x1", "x2").alias("x1"), swap("y1", "y2").alias("y1"), swap("x2", "x1").alias("x2"), swap("y2", "y1").alias("y2"))
    return s.select("sheet_id", "line_ix", *[c.alias(n) for c, n in zip(g.ordered_ends(g.box()), ("x1", "y1", "x2", "y2"), strict=True)])


@query("l06_tile_anchors", "select sheet_id, w, x from (select sheet_id, w, unnest(list_distinct(list_append(range(0, greatest(1, w-1280+1), 1024), greatest(0, w-1280)))) as x from (select sheet_id, max(x2)+100 as w from symbols group by sheet_id))")
def l06(spark, sf):
    w = d.symbols(spark, sf).groupBy("sheet_id").agg((F.max("x2") + 100).alias("w"))
    return w.select("sheet_id", "w", F.explode(tile_anchors(F.col("w"), 1280, 256)).alias("x"))


def tile_anchors(size, tile: int, overlap: int):
    """Left edges of tiles that cover 0..size; the last tile ends at the edge."""
    last = F.greatest(F.lit(0), size - tile)
    return F.array_distinct(F.concat(F.sequence(F.lit(0).cast("long"), last.cast("long"), F.lit(tile - overlap).cast("long")), F.array(last.cast("long"))))
