"""Queries of aggregates, windows, clusters, layers, crops, set operations and report selections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sheetgraph.functions import text as t
from sheetgraph.operators import clusters as cl
from sheetgraph.operators import crops as cr
from sheetgraph.operators import layers as la
from sheetgraph.operators import lines as ln
from sheetgraph.plans.crossings import _BOXED, boxes, raw_runs, straight
from sheetgraph.plans.registry import query
from sheetgraph.sources import derived as d

KEY = ["sheet_id"]
#: Text boxes as detections of tiles: enlarged so that neighbours overlap.
_DET = "det as (select sheet_id, text_ix as id, text, cast(x1-40 as double) as x1, cast(y1-20 as double) as y1, cast(x2+40 as double) as x2, cast(y2+20 as double) as y2, 0.5 + (text_ix % 10)/20.0 as score from texts)"


def detections(spark, sf):
    move = {"x1": -40, "y1": -20, "x2": 40, "y2": 20}
    return d.texts(spark, sf).select("sheet_id", F.col("text_ix").alias("id"), "text", *[(F.col(c) + m).cast("double").alias(c) for c, m in move.items()], (0.5 + (F.col("text_ix") % 10) / 20).alias("score"))


_OV = "greatest(0,least(a.x2,b.x2)-greatest(a.x1,b.x1))*greatest(0,least(a.y2,b.y2)-greatest(a.y1,b.y1))"
_AR = "((a.x2-a.x1)*(a.y2-a.y1))"
_SAME = f"same_ as (select a.sheet_id, a.id as a_id, b.id as b_id from det a join det b on a.sheet_id=b.sheet_id and a.id<b.id where {_OV}/(2*{_AR}-{_OV}) > 0.2 or {_OV}/{_AR} > 0.6)"
_CC = "both_ as (select sheet_id, a_id as a, b_id as b from {p} union select sheet_id, b_id, a_id from {p}), reach(sheet_id, n, m) as (select sheet_id, id, id from det union select r.sheet_id, b.b, r.m from reach r join both_ b on r.sheet_id=b.sheet_id and r.n=b.a where r.m < b.b), comp as (select sheet_id, n as id, min(m) as cluster from reach group by all)"


@query("j17_same_regions", f", {_DET}, {_SAME} select * from same_")
def j17(spark, sf):
    return cl.same_regions(detections(spark, sf), KEY, "id")


@query("ag06_best_of_cluster", f", {_DET}, {_SAME}, {_CC.format(p='same_')} select d.sheet_id, d.id, d.text from det d join comp using (sheet_id, id) qualify row_number() over (partition by d.sheet_id, cluster order by length(text)*score desc, d.id) = 1")
def ag06(spark, sf):
    return cl.deduplicated(detections(spark, sf), KEY, "id", "text", "score").select("sheet_id", "id", "text")


_STACK = f"stack_ as (select a.sheet_id, a.id as a_id, b.id as b_id from det a join det b on a.sheet_id=b.sheet_id and a.id<b.id where case when a.y1<=b.y1 then b.y1-a.y2 else a.y1-b.y2 end <= 10 and case when a.y1<=b.y1 then b.y1-a.y2 else a.y1-b.y2 end > -1000 and greatest(0,least(a.x2,b.x2)-greatest(a.x1,b.x1))/(a.x2-a.x1) > 0.8 and length(trim(a.text))<=12 and length(trim(b.text))<=12 and not regexp_matches(trim(a.text),'{t.EQUIPMENT_TAG}') and not regexp_matches(trim(b.text),'{t.EQUIPMENT_TAG}'))"


@query("j18_stacked_lines", f", {_DET}, {_STACK} select * from stack_")
def j18(spark, sf):
    return cl.stacked(detections(spark, sf), KEY, "id", "text")


@query("ag07_merged_lines", f", {_DET}, {_STACK}, {_CC.format(p='stack_')}, unit as (select d.*, case when count(*) over (partition by d.sheet_id, cluster) > 3 then d.id else cluster end as u from det d join comp using (sheet_id, id)) select sheet_id, u as id, string_agg(text, ' ' order by y1, x1, id) as text, max(score) as score, count(*) as count from unit group by sheet_id, u")
def ag07(spark, sf):
    return cl.merged_lines(detections(spark, sf), KEY, "id", "text", "score").select("sheet_id", "id", "text", "score", "count")


_LAY = """, lay as (select sheet_id, axis, case when line_ix%3=0 then 'red' else 'black' end as layer, case when line_ix%3=0 then 'red:' else 'black:' end || line_ix as run_id, pos, lo, hi, line_type='dashed' as dashed from segments),
i0 as (select *, case when lo - max(hi) over (partition by sheet_id, axis, (pos+1)//20 order by lo, run_id rows between unbounded preceding and 1 preceding) <= 25 then 0 else 1 end as st from lay),
i1 as (select *, sum(st) over (partition by sheet_id, axis, (pos+1)//20 order by lo, run_id rows unbounded preceding) as island from i0),
j as (select sheet_id, axis, min(run_id) as run_id, min(lo) as lo, max(hi) as hi, round(sum(pos*(hi-lo+1))/sum(hi-lo+1),6) as pos, bool_or(dashed) as dashed, case when count(distinct layer)>1 then 'both' else min(layer) end as layer, count(distinct layer) as layers from i1 group by sheet_id, axis, (pos+1)//20, island)"""


def layered(spark, sf):
    s = d.segments(spark, sf).select("sheet_id", "axis", F.col("line_ix").alias("run_id"), F.col("pos").cast("double").alias("pos"), F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi"), (F.col("line_type") == "dashed").alias("dashed"))
    return la.load_layer(s.where("run_id % 3 = 0"), "red").unionByName(la.load_layer(s.where("run_id % 3 <> 0"), "black"))


@query("j12_rejoined_layers", f"{_LAY} select sheet_id, axis, run_id, cast(lo as double) as lo, cast(hi as double) as hi, pos, dashed, layer from j")
def j12(spark, sf):
    return la.rejoined(layered(spark, sf), KEY, 2.5, 25.0).withColumn("pos", F.round("pos", 6))


@query("ag05_layer_totals", f"{_LAY} select sheet_id, layer, count(*) as n, count(*) filter (dashed) as dashed from j group by all")
def ag05(spark, sf):
    return la.rejoined(layered(spark, sf), KEY, 2.5, 25.0).groupBy("sheet_id", "layer").agg(F.count("*").alias("n"), F.count_if("dashed").alias("dashed"))


_ENT = "ent as (select sheet_id, axis || pos as run_id, lo as at_, line_ix as point_id, case when line_ix % 4 = 0 then line_ix end as sym from segments)"


def line_entries(spark, sf):
    sym = F.when(F.col("line_ix") % 4 == 0, F.array("line_ix")).otherwise(F.array().cast("array<bigint>"))
    return d.segments(spark, sf).select("sheet_id", F.concat("axis", F.col("pos").cast("string")).alias("run_id"), F.col("lo").alias("at"), F.col("line_ix").alias("point_id"), sym.alias("symbols"))


@query("w07_neighbours_along", f", {_ENT} select sheet_id, run_id, point_id, last_value(sym ignore nulls) over (partition by sheet_id, run_id order by at_, point_id rows between unbounded preceding and 1 preceding) as before, first_value(sym ignore nulls) over (partition by sheet_id, run_id order by at_, point_id rows between 1 following and unbounded following) as after from ent")
def w07(spark, sf):
    n = la.neighbours_along(line_entries(spark, sf), KEY)
    return n.select("sheet_id", "run_id", "point_id", F.col("before")[0].alias("before"), F.col("after")[0].alias("after"))


@query("gr17_cross_layer_points", "select sheet_id, pos as point_id, string_agg(distinct case when line_ix%3=0 then 'red' else 'black' end, ',' order by case when line_ix%3=0 then 'red' else 'black' end) as layers from segments group by sheet_id, pos having count(distinct line_ix%3=0) > 1")
def gr17(spark, sf):
    s = d.segments(spark, sf)
    runs = s.select("sheet_id", F.col("line_ix").alias("run_id"), F.when(F.col("line_ix") % 3 == 0, "red").otherwise("black").alias("layer"))
    return la.cross_layer_points(s.select("sheet_id", F.col("line_ix").alias("run_id"), F.col("pos").alias("point_id")), runs, KEY).select("sheet_id", "point_id", F.array_join("layers", ",").alias("layers"))


@query("o07_cross_layer_links", "select a.sheet_id, a.line_ix as a, b.line_ix as b from segments a join segments b on a.sheet_id=b.sheet_id and b.line_ix=a.line_ix+1 where (a.line_ix%3=0) <> (b.line_ix%3=0)")
def o07(spark, sf):
    s = d.segments(spark, sf).select("sheet_id", "line_ix", (F.col("line_ix") % 3 == 0).alias("red"))
    b = s.select("sheet_id", (F.col("line_ix") - 1).alias("line_ix"), F.col("line_ix").alias("b"), F.col("red").alias("other"))
    return s.join(b, ["sheet_id", "line_ix"]).where("red <> other").select("sheet_id", F.col("line_ix").alias("a"), "b")


_G = "sqrt(pow(greatest(t.x1-s.x2,s.x1-t.x2,0),2)+pow(greatest(t.y1-s.y2,s.y1-t.y2,0),2))"


@query("j13_nearest_symbol", f"select t.sheet_id, t.text_ix, round(coalesce(min({_G}),1e9),6) as symbol_distance from texts t left join symbols s on s.sheet_id=t.sheet_id group by t.sheet_id, t.text_ix")
def j13(spark, sf):
    return cr.nearest_symbol(d.texts(spark, sf), d.symbols(spark, sf), KEY).select("sheet_id", "text_ix", F.round("symbol_distance", 6).alias("symbol_distance"))


_SIDE = f""", {_BOXED}, big as (select s.* from segments s left join boxed b using (sheet_id, line_ix) where b.line_ix is null and s.hi - s.lo > 2), near_ as (select t.sheet_id, t.text_ix, l.line_ix, l.axis, l.pos, case when axis='h' then (case when pos<t.y1 then 'above' when pos>t.y2 then 'below' end) else (case when pos<t.x1 then 'left' when pos>t.x2 then 'right' end) end as side,
 case when axis='h' then sqrt(pow(greatest(t.y1-pos,pos-t.y2,0),2)+pow(greatest(t.x1-hi,lo-t.x2,0),2)) else sqrt(pow(greatest(t.x1-pos,pos-t.x2,0),2)+pow(greatest(t.y1-hi,lo-t.y2,0),2)) end as dist from texts t join big l on t.sheet_id=l.sheet_id),
best as (select * from near_ where side is not null qualify row_number() over (partition by sheet_id, text_ix, side order by dist, line_ix) = 1),
wide as (select sheet_id, text_ix, max(case when side='above' then line_ix end) as above, max(case when side='below' then line_ix end) as below, max(case when side='left' then line_ix end) as left_, max(case when side='right' then line_ix end) as right_, max(case when side='above' then pos end) as pa, max(case when side='below' then pos end) as pb, max(case when side='left' then pos end) as pl, max(case when side='right' then pos end) as pr, count(*) as sides_found from best group by all)"""


def sided(spark, sf):
    """Each text's nearest unboxed segments."""
    return cr.sides(d.texts(spark, sf), unboxed(spark, sf), KEY)


def unboxed(spark, sf):
    """Segments that are no box's own drawing and have a direction (over 2 pixels)."""
    return ln.mark_boxed(straight(spark, sf), boxes(spark, sf), KEY).where("not boxed and hi - lo > 2")


@query("j14_nearest_lines", f"{_SIDE} select sheet_id, text_ix, above, below, left_, right_ from wide")
def j14(spark, sf):
    return sided(spark, sf).select("sheet_id", "text_ix", F.col("above.line_ix").alias("above"), F.col("below.line_ix").alias("below"), F.col("left.line_ix").alias("left_"), F.col("right.line_ix").alias("right_"))


@query("l07_crops", f"{_SIDE}, c as (select sheet_id, text_ix, sides_found, t.x1, t.y1, t.x2, t.y2, greatest(0, least(t.x1,coalesce(pl,t.x1))-8) as cx1, greatest(0, least(t.y1,coalesce(pa,t.y1))-8) as cy1, least(4000, greatest(t.x2,coalesce(pr,t.x2))+8) as cx2, least(3000, greatest(t.y2,coalesce(pb,t.y2))+8) as cy2 from wide join texts t using (sheet_id, text_ix)) select sheet_id, text_ix, cast(sides_found as int) as sides_found, cast(cx1 as int) as cx1, cast(cy1 as int) as cy1, cast(cx2 as int) as cx2, cast(cy2 as int) as cy2, cx1<=x1 and cy1<=y1 and x2<=cx2 and y2<=cy2 as contains_text from c where cx2-cx1>=24 and cy2-cy1>=24")
def l07(spark, sf):
    return cr.crop(sided(spark, sf), d.WIDTH, d.HEIGHT).select("sheet_id", "text_ix", "sides_found", "cx1", "cy1", "cx2", "cy2", "contains_text")


@query("l08_axis_midpoints", f", {_BOXED} select sheet_id, line_ix, axis, case when axis='h' then (lo+hi)/2.0 else pos end as mid_x, case when axis='h' then pos else (lo+hi)/2.0 end as mid_y from segments s left join boxed b using (sheet_id, line_ix) where b.line_ix is null and s.hi - s.lo > 2")
def l08(spark, sf):
    return unboxed(spark, sf).select("sheet_id", "line_ix", "axis", ((F.col("x1") + F.col("x2")) / 2).alias("mid_x"), ((F.col("y1") + F.col("y2")) / 2).alias("mid_y"))


# --- aggregates


@query("ag09_valve_scale", "select sheet_id, case when count(*) filter (v) < 8 then 1.0 else round_even(least(greatest(75.0/median(w) filter (v),1.0),4.0),2) end as scale from (select sheet_id, starts_with(label,'Instrument/Valve/') as v, x2-x1 + symbol_id%5 as w from symbols) group by sheet_id")
def ag09(spark, sf):
    w = F.when(F.col("label").startswith("Instrument/Valve/"), F.col("x2") - F.col("x1") + F.col("symbol_id") % 5)
    scale = F.bround(F.least(F.greatest(F.try_divide(F.lit(75.0), F.median(w)), F.lit(1.0)), F.lit(4.0)), 2)
    return d.symbols(spark, sf).groupBy("sheet_id").agg(F.when(F.count(w) < 8, 1.0).otherwise(scale).alias("scale"))


@query("ag10_variation", "select sheet_id, axis, round(case when count(*)<2 then 0 when avg(hi-lo)=0 then cast('inf' as double) else stddev_pop(hi-lo)/avg(hi-lo) end,6) as cv from segments group by sheet_id, axis")
def ag10(spark, sf):
    return d.segments(spark, sf).groupBy("sheet_id", "axis").agg(F.round(ln.variation(F.col("hi") - F.col("lo")), 6).alias("cv"))


_PROFILE = """prof as (select sheet_id, axis || pos as run_id, line_ix, lo + 7*k as at_, case when line_ix % 2 = 0 then k % 8 < 5 else k % 5 < 2 end or line_ix % 11 = 0 as ink from segments, (select unnest(range(0,40)) as k))"""


def profiles(spark, sf):
    """Made-up stroke profiles: 5 of 8 samples are ink (dashes), or 2 of 5 (too short for dashes), or all."""
    s = d.segments(spark, sf).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(39))))
    return s.select("sheet_id", F.concat("axis", F.col("pos").cast("string")).alias("run_id"), "line_ix", (F.col("lo") + 7 * F.col("k")).alias("at"), (F.when(F.col("line_ix") % 2 == 0, F.col("k") % 8 < 5).otherwise(F.col("k") % 5 < 2) | (F.col("line_ix") % 11 == 0)).alias("ink"))


_RLE = f", {_PROFILE}, ch as (select *, case when ink = lag(ink) over (partition by sheet_id, line_ix order by at_) then 0 else 1 end as c from prof), rl as (select sheet_id, line_ix, r, ink, min(at_) as first, count(*) as length from (select *, sum(c) over (partition by sheet_id, line_ix order by at_ rows unbounded preceding) as r from ch) group by all)"


@query("w05_stroke_runs", f"{_RLE} select sheet_id, line_ix, ink, first, length from rl")
def w05(spark, sf):
    return ln.stroke_runs(profiles(spark, sf), ["sheet_id", "line_ix"], "at", "ink")


@query("w06_dash_chunks", f"{_RLE} select sheet_id, line_ix, first, length, ink from (select *, min(first) over (partition by sheet_id, line_ix) as a, max(first) over (partition by sheet_id, line_ix) as b from rl) where first > a and first < b")
def w06(spark, sf):
    runs = ln.stroke_runs(profiles(spark, sf), ["sheet_id", "line_ix"], "at", "ink")
    return ln.dash_chunks(runs, ["sheet_id", "line_ix"]).select("sheet_id", "line_ix", "first", "length", "ink")


@query("ag11_dash_verdicts", f"{_RLE}, inn as (select * from (select *, min(first) over (partition by sheet_id, line_ix) as a, max(first) over (partition by sheet_id, line_ix) as b from rl) where first > a and first < b) select sheet_id, line_ix, median(length) filter (ink) as dash, median(length) filter (not ink) as gap, count(*) filter (not ink) >= 2 and median(length) filter (not ink) between 2 and 25 and median(length) filter (ink) between 4 and 60 and stddev_pop(length) filter (not ink) / avg(length) filter (not ink) < 0.45 and stddev_pop(length) filter (ink) / avg(length) filter (ink) < 0.45 as dashed from inn group by sheet_id, line_ix")
def ag11(spark, sf):
    runs = ln.stroke_runs(profiles(spark, sf), ["sheet_id", "line_ix"], "at", "ink")
    v = ln.dash_verdicts(ln.dash_chunks(runs, ["sheet_id", "line_ix"]), ["sheet_id", "line_ix"])
    return v.select("sheet_id", "line_ix", "dash", "gap", "dashed")


_CMP = "cmp as (select a.sheet_id, a.symbol_id as a_id, b.symbol_id as b_id, a.label as la, b.label as lb, a.text_associated as ta, b.text_associated as tb from symbols a join symbols b on a.sheet_id=b.sheet_id and b.symbol_id=a.symbol_id+3)"


def compared(spark, sf):
    s = d.symbols(spark, sf)
    a = s.select("sheet_id", F.col("symbol_id").alias("a_id"), F.col("label").alias("la"), F.col("text_associated").alias("ta"))
    b = s.select("sheet_id", (F.col("symbol_id") - 3).alias("a_id"), F.col("label").alias("lb"), F.col("text_associated").alias("tb"))
    return a.join(b, ["sheet_id", "a_id"])


@query("ag12_agreement", f", {_CMP} select sheet_id, count(*) as pairs, count(*) filter (la=lb) as same_label, count(*) filter (ta is not null and tb is not null) as both_tagged, round(100.0*count(*) filter (la=lb)/greatest(count(*),1),4) as percent from cmp group by sheet_id")
def ag12(spark, sf):
    both = t.compared_tag(F.col("ta")).isNotNull() & t.compared_tag(F.col("tb")).isNotNull()
    same = F.count_if(t.leaf(F.col("la")) == t.leaf(F.col("lb")))
    return compared(spark, sf).groupBy("sheet_id").agg(F.count("*").alias("pairs"), same.alias("same_label"), F.count_if(both).alias("both_tagged"), F.round(100 * same / F.greatest(F.count("*"), F.lit(1)), 4).alias("percent"))


@query("ag13_label_confusion", f", {_CMP} select split_part(la,'/',-1) as a, split_part(lb,'/',-1) as b, count(*) as n from cmp where la<>lb group by all order by n desc, a, b limit 5")
def ag13(spark, sf):
    c = compared(spark, sf).where("la <> lb").groupBy(t.leaf(F.col("la")).alias("a"), t.leaf(F.col("lb")).alias("b")).agg(F.count("*").alias("n"))
    return c.orderBy(F.desc("n"), "a", "b").limit(5)


@query("ag14_class_histogram", "select sheet_id, label, count(*) as n from symbols group by sheet_id, label")
def ag14(spark, sf):
    return d.symbols(spark, sf).groupBy("sheet_id", "label").agg(F.count("*").alias("n"))


#: Symbols joined by a segment that both hold an end of, and the segments with such a pair.
_LINKS = """, two_ as (select distinct sheet_id, node, symbol_id from hold), lk as (select a.sheet_id, a.node, a.symbol_id as a, b.symbol_id as b from two_ a join two_ b on a.sheet_id=b.sheet_id and a.node=b.node and a.symbol_id<b.symbol_id), pr as (select distinct sheet_id, a, b from lk), used as (select distinct sheet_id, node as line_ix from lk)"""


def _hold_sql():
    from sheetgraph.plans.connect import _LN

    return _LN + ", hold as (select sheet_id, line_ix as node, node as symbol_id from (select * from hits qualify row_number() over (partition by sheet_id, line_ix, side order by distance, phase, node) = 1) where type = 'symbol')" + _LINKS


def symbol_segments(spark, sf):
    """(sheet_id, line_ix, a, b) with a < b: symbols at the two ends of a segment."""
    from sheetgraph.operators import candidates as c
    from sheetgraph.plans.connect import _hits

    held = c.first_holders(_hits(spark, sf, "symbol"), _hits(spark, sf, "text")).where("type = 'symbol'").select("sheet_id", "line_ix", "side", F.col("node").alias("symbol_id"))
    a = held.where("side = 'start'").select("sheet_id", "line_ix", F.col("symbol_id").alias("p"))
    b = held.where("side = 'end'").select("sheet_id", "line_ix", F.col("symbol_id").alias("q"))
    return a.join(b, ["sheet_id", "line_ix"]).where("p <> q").select("sheet_id", "line_ix", F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))


@query("ag16_connectivity", _hold_sql() + """, ends_ as (select sheet_id, a as symbol_id from pr union select sheet_id, b from pr) select s.sheet_id, s.symbols, coalesce(l.linked,0) as linked, s.symbols - coalesce(l.linked,0) as isolated, coalesce(e.edges,0) as edges, g.segments, coalesce(u.used,0) as used, round(100.0*(g.segments-coalesce(u.used,0))/greatest(g.segments,1),4) as orphan_percent
from (select sheet_id, count(*) as symbols from symbols group by all) s join (select sheet_id, count(*) as segments from segments group by all) g using (sheet_id) left join (select sheet_id, count(*) as linked from ends_ group by all) l using (sheet_id) left join (select sheet_id, count(*) as edges from pr group by all) e using (sheet_id) left join (select sheet_id, count(*) as used from used group by all) u using (sheet_id)""")
def ag16(spark, sf):
    return connectivity(d.symbols(spark, sf), d.segments(spark, sf), symbol_segments(spark, sf))


def connectivity(symbols, segments, links):
    """Of each sheet: symbols, those linked and isolated, undirected edges, segments, those on a link, and the share that is not."""
    pairs = links.select("sheet_id", "a", "b").distinct()
    n = lambda df, name: df.groupBy("sheet_id").agg(F.count("*").alias(name))
    ends = pairs.select("sheet_id", F.explode(F.array("a", "b")).alias("symbol_id")).distinct()
    out = n(symbols, "symbols").join(n(segments, "segments"), "sheet_id")
    for part in (n(ends, "linked"), n(pairs, "edges"), n(links.select("sheet_id", "line_ix").distinct(), "used")):
        out = out.join(part, "sheet_id", "left")
    out = out.na.fill(0, ["linked", "edges", "used"]).withColumn("isolated", F.col("symbols") - F.col("linked"))
    return out.withColumn("orphan_percent", F.round(100 * (F.col("segments") - F.col("used")) / F.greatest(F.col("segments"), F.lit(1)), 4)).select("sheet_id", "symbols", "linked", "isolated", "edges", "segments", "used", "orphan_percent")


@query("ag17_extents", "select sheet_id, min(x1) as x1, min(y1) as y1, max(x2) as x2, max(y2) as y2 from symbols group by sheet_id")
def ag17(spark, sf):
    return d.symbols(spark, sf).groupBy("sheet_id").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))


@query("ag19_median_centre", "select sheet_id, median((x1+x2)/2.0) as x, median((y1+y2)/2.0) as y from symbols group by sheet_id")
def ag19(spark, sf):
    return d.symbols(spark, sf).groupBy("sheet_id").agg(F.median((F.col("x1") + F.col("x2")) / 2).alias("x"), F.median((F.col("y1") + F.col("y2")) / 2).alias("y"))


# --- windows, order, sets


@query("w04_anchored_clusters", ", ps as (select sheet_id, axis, list(distinct cast(pos as double) order by cast(pos as double)) as p from segments group by all), cl as (select sheet_id, axis, 0 as cluster, p[1] as anchor, p from ps union all select sheet_id, axis, cluster + 1, q[1], p from (select *, list_filter(p, lambda x: x > anchor + 45) as q from cl) where len(q) > 0) select sheet_id, axis, cluster, anchor from cl")
def w04(spark, sf):
    a = d.segments(spark, sf).groupBy("sheet_id", "axis").agg(F.collect_set(F.col("pos").cast("double")).alias("p"))
    return a.select("sheet_id", "axis", F.posexplode(ln.anchored_clusters(F.col("p"), 45.0)).alias("cluster", "anchor"))


@query("w08_renumbered", "select sheet_id, symbol_id, row_number() over (partition by sheet_id order by y1, x1, symbol_id) - 1 as new_id from symbols")
def w08(spark, sf):
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", (F.row_number().over(Window.partitionBy("sheet_id").orderBy("y1", "x1", "symbol_id")) - 1).alias("new_id"))


@query("w09_bridged_chains", """, ps as (select sheet_id, axis, pos, cast(lo as double) as lo, cast(hi as double) as hi, line_ix%3<>0 as evidence, cast(line_ix%4 as int) as crossings, row_number() over (partition by sheet_id, axis, pos order by lo, hi, line_ix%3<>0, line_ix%4) as k from segments),
f as (select sheet_id, axis, pos, k, lo, hi, 1 as pieces, 1 as chain from ps where k=1 union all select p.sheet_id, p.axis, p.pos, p.k, case when ok then f_lo else p.lo end, case when ok then greatest(f_hi, p.hi) else p.hi end, case when ok then f_pieces + 1 else 1 end, case when ok then f_chain else f_chain + 1 end
 from (select p.*, f.lo as f_lo, f.hi as f_hi, f.pieces as f_pieces, f.chain as f_chain, p.lo - f.hi <= 0 or (p.lo - f.hi <= 600 and p.evidence and p.crossings <= 2) as ok from f join ps p on p.sheet_id=f.sheet_id and p.axis=f.axis and p.pos=f.pos and p.k=f.k+1) p)
select sheet_id, axis, pos, lo, hi, pieces from f qualify row_number() over (partition by sheet_id, axis, pos, chain order by k desc) = 1""")
def w09(spark, sf):
    s = d.segments(spark, sf).select("sheet_id", "axis", "pos", "lo", "hi", (F.col("line_ix") % 3 != 0).alias("evidence"), (F.col("line_ix") % 4).cast("int").alias("crossings"))
    return ln.bridged(s, ["sheet_id", "axis", "pos"])


@query("w10_level_keys", "select sheet_id, axis, cast(round_even(pos/15.0,0) as bigint) as level, count(*) as n from segments group by all")
def w10(spark, sf):
    return d.segments(spark, sf).groupBy("sheet_id", "axis", F.bround(F.col("pos") / 15).cast("long").alias("level")).agg(F.count("*").alias("n"))


@query("o01_sorted_by_length", "select sheet_id, line_ix, row_number() over (partition by sheet_id order by hi-lo desc, line_ix) as rank from segments")
def o01(spark, sf):
    return d.segments(spark, sf).select("sheet_id", "line_ix", F.row_number().over(Window.partitionBy("sheet_id").orderBy(F.desc(F.col("hi") - F.col("lo")), "line_ix")).alias("rank"))


@query("o02_top_and_offset", "select sheet_id, line_ix from segments order by hi-lo desc, sheet_id, line_ix limit 20 offset 10")
def o02(spark, sf):
    return d.segments(spark, sf).orderBy(F.desc(F.col("hi") - F.col("lo")), "sheet_id", "line_ix").offset(10).limit(20).select("sheet_id", "line_ix")


@query("o03_union_of_boxes", "select sheet_id, 'symbol' as kind, x1, y1 from symbols union all select sheet_id, 'text', x1, y1 from texts")
def o03(spark, sf):
    pick = lambda df, k: df.select("sheet_id", F.lit(k).alias("kind"), "x1", "y1")
    return pick(d.symbols(spark, sf), "symbol").unionByName(pick(d.texts(spark, sf), "text"))


@query("o04_set_difference", "select sheet_id, symbol_id from symbols except select sheet_id, symbol_id from symbols where starts_with(label,'Instrument/Valve/')")
def o04(spark, sf):
    s = d.symbols(spark, sf)
    return s.select("sheet_id", "symbol_id").subtract(s.where(F.col("label").startswith("Instrument/Valve/")).select("sheet_id", "symbol_id"))


@query("o05_set_intersection", "select sheet_id, list_sort(list_intersect(list(distinct chr(65 + cast(symbol_id % 9 as int))), ['A','D','G','Z'])) as letters from symbols group by sheet_id")
def o05(spark, sf):
    own = F.collect_set(F.chr((65 + F.col("symbol_id") % 9).cast("int")))
    return d.symbols(spark, sf).groupBy("sheet_id").agg(F.array_sort(F.array_intersect(own, F.array(*[F.lit(c) for c in "ADGZ"]))).alias("letters"))


@query("o06_distinct_sorted_pairs", "select distinct sheet_id, least(a_id,b_id) as a, greatest(a_id,b_id) as b from pairs order by all")
def o06(spark, sf):
    return d.pairs(spark, sf).select("sheet_id", F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct().orderBy("sheet_id", "a", "b")


# --- selections of reports


@query("r01_pairs_and_isolated", _hold_sql() + """ select sheet_id, 'pair' as kind, a, b from pr union all select s.sheet_id, 'isolated', symbol_id, null from symbols s where not exists (select 1 from pr where pr.sheet_id=s.sheet_id and (pr.a=s.symbol_id or pr.b=s.symbol_id))""")
def r01(spark, sf):
    pairs = symbol_segments(spark, sf).select("sheet_id", "a", "b").distinct()
    linked = pairs.select("sheet_id", F.explode(F.array("a", "b")).alias("symbol_id"))
    alone = d.symbols(spark, sf).join(linked, ["sheet_id", "symbol_id"], "left_anti").select("sheet_id", F.lit("isolated").alias("kind"), F.col("symbol_id").alias("a"), F.lit(None).cast("long").alias("b"))
    return pairs.select("sheet_id", F.lit("pair").alias("kind"), "a", "b").unionByName(alone)


def _boxed_sql():
    from sheetgraph.plans.crossings import _BOXED

    return _hold_sql() + ", " + _BOXED


@query("r02_segment_disposition", _boxed_sql() + """, same as (select distinct s.sheet_id, s.line_ix from straight s join straight u on u.sheet_id=s.sheet_id and u.x1=s.x1 and u.y1=s.y1 and u.x2=s.x2 and u.y2=s.y2 join used on used.sheet_id=u.sheet_id and used.line_ix=u.line_ix)
select g.sheet_id, g.line_ix, case when s.line_ix is not null then 'used' when b.line_ix is not null then 'boxed' when line_type='dashed' then 'dashed' else 'orphan' end as disposition from segments g left join same s using (sheet_id, line_ix) left join boxed b using (sheet_id, line_ix)""")
def r02(spark, sf):
    from sheetgraph.operators import lines as lo
    from sheetgraph.plans.crossings import boxes, straight

    ends = F.struct(*[F.bround(F.col(c), 4) for c in ("x1", "y1", "x2", "y2")])
    by_ends = d.normalized(straight(spark, sf)).select("sheet_id", "line_ix", ends.alias("ends"))
    used = by_ends.join(symbol_segments(spark, sf).select("sheet_id", "line_ix").distinct(), ["sheet_id", "line_ix"]).select("sheet_id", "ends").distinct()
    hit = by_ends.join(used, ["sheet_id", "ends"], "left_semi").select("sheet_id", "line_ix", F.lit(True).alias("used"))
    marked = lo.mark_boxed(straight(spark, sf), boxes(spark, sf), KEY).join(hit, ["sheet_id", "line_ix"], "left")
    kind = F.when(F.col("used"), "used").when(F.col("boxed"), "boxed").when(F.col("line_type") == "dashed", "dashed").otherwise("orphan")
    return marked.select("sheet_id", "line_ix", kind.alias("disposition"))


@query("j21_by_rounded_ends", "select sheet_id, line_ix from segments s where exists (select 1 from segments u where u.sheet_id=s.sheet_id and u.line_ix%9=0 and u.axis=s.axis and u.pos=s.pos and u.lo=s.lo and u.hi=s.hi)")
def j21(spark, sf):
    ends = F.struct(*[F.bround(F.col(c), 4) for c in ("x1", "y1", "x2", "y2")])
    s = d.normalized(straight(spark, sf)).withColumn("ends", ends)
    return s.join(s.where("line_ix % 9 = 0").select("sheet_id", "ends"), ["sheet_id", "ends"], "left_semi").select("sheet_id", "line_ix")


@query("r03_asset_by_corner", "select sheet_id, symbol_id, exists(select 1 from symbols a where a.sheet_id=s.sheet_id and starts_with(a.label,'Equipment/') and a.x1=s.x1 and a.y1=s.y1) as is_asset from symbols s")
def r03(spark, sf):
    s = d.normalized(d.symbols(spark, sf)).withColumn("corner", F.struct(F.bround("x1", 4), F.bround("y1", 4)))
    a = s.where(F.col("label").startswith("Equipment/")).select("sheet_id", "corner").distinct().withColumn("hit", F.lit(True))
    return s.join(a, ["sheet_id", "corner"], "left").select("sheet_id", "symbol_id", F.coalesce("hit", F.lit(False)).alias("is_asset"))


def _leaders_sql():
    from sheetgraph.plans.connect import _ATTACHED

    return _ATTACHED + """ select a.sheet_id, a.text_ix, a.kind, a.id, (t.x1+t.x2)/2.0 as from_x, (t.y1+t.y2)/2.0 as from_y, (g.x1+g.x2)/2.0 as to_x, (g.y1+g.y2)/2.0 as to_y from att a join texts t on t.sheet_id=a.sheet_id and t.text_ix=a.text_ix join tg g on g.sheet_id=a.sheet_id and g.id=a.id and g.kd=case a.kind when 'symbol' then 0 else 1 end"""


@query("r04_leader_pairs", _leaders_sql())
def r04(spark, sf):
    """From the centre of each attached text to the centre of its symbol or line."""
    from sheetgraph.plans.connect import j06
    from sheetgraph.plans.crossings import straight

    mid = lambda a, b, n: ((F.col(a) + F.col(b)) / 2).alias(n)
    place = lambda df, kind, key, x, y: df.select("sheet_id", F.lit(kind).alias("kind"), F.col(key).alias("id"), mid("x1", "x2", x), mid("y1", "y2", y))
    targets = place(d.symbols(spark, sf), "symbol", "symbol_id", "to_x", "to_y").unionByName(place(straight(spark, sf), "line", "line_ix", "to_x", "to_y"))
    texts = place(d.texts(spark, sf), "text", "text_ix", "from_x", "from_y").select("sheet_id", F.col("id").alias("text_ix"), "from_x", "from_y")
    return j06(spark, sf).join(texts, ["sheet_id", "text_ix"]).join(targets, ["sheet_id", "kind", "id"]).select("sheet_id", "text_ix", "kind", "id", "from_x", "from_y", "to_x", "to_y")


@query("r05_viewer_payload", "select sheet_id, symbol_id, row_number() over (partition by sheet_id order by case when starts_with(label,'Equipment/') then 'equipment' when starts_with(label,'Instrument/Valve/') then 'valve' when starts_with(label,'Piping/') then 'fitting' when starts_with(label,'Instrument/') then 'instrument' else 'other' end, coalesce(nullif(text_associated,''), split_part(label,'/',-1) || ' #' || symbol_id), symbol_id) as place from symbols")
def r05(spark, sf):
    s = d.symbols(spark, sf)
    name = t.display_name(F.col("text_associated"), F.col("label"), F.col("symbol_id"))
    return s.select("sheet_id", "symbol_id", F.row_number().over(Window.partitionBy("sheet_id").orderBy(t.category(F.col("label")), name, "symbol_id")).alias("place"))


@query("j20_corner_snaps", "select h.sheet_id, h.line_ix as h_id, v.line_ix as v_id, abs(v.pos-e) as dx, abs(h.pos-f) as dy from (select *, unnest([lo,hi]) as e from segments where axis='h') h join (select *, unnest([lo,hi]) as f from segments where axis='v') v on h.sheet_id=v.sheet_id and v.pos<>e and abs(v.pos-e)<=30 and abs(h.pos-f)<=30")
def j20(spark, sf):
    from sheetgraph.operators.spatial import box_join

    r = raw_runs(spark, sf).withColumn("end", F.explode(F.array("lo", "hi")))
    h = r.where("axis = 'h'").select("sheet_id", F.col("run_id").alias("h_id"), F.col("end").alias("hx"), F.col("pos").alias("hy"))
    v = r.where("axis = 'v'").select("sheet_id", F.col("run_id").alias("v_id"), F.col("pos").alias("vx"), F.col("end").alias("vy"))
    p = box_join(h, v, KEY, tuple(map(F.col, ("hx", "hy", "hx", "hy"))), tuple(map(F.col, ("vx", "vy", "vx", "vy"))), 30.0, 200.0).where("hx <> vx")
    return p.select("sheet_id", "h_id", "v_id", F.abs(F.col("vx") - F.col("hx")).cast("long").alias("dx"), F.abs(F.col("vy") - F.col("hy")).cast("long").alias("dy"))
