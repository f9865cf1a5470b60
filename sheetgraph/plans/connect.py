"""Queries of the candidate graph, greedy selection and traversal."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetgraph.functions import geometry as g
from sheetgraph.functions import text as t
from sheetgraph.operators import candidates as c
from sheetgraph.operators import graph as gr
from sheetgraph.operators import greedy as gd
from sheetgraph.operators.spatial import box_join
from sheetgraph.plans.crossings import _BOXED, straight
from sheetgraph.plans.registry import query
from sheetgraph.sources import derived as d

KEY = ["sheet_id"]
UNIT = float(max(d.WIDTH, d.HEIGHT))
CELL = 100.0 / UNIT


def lines(spark, sf):
    """Straight segments in fractions."""
    return d.normalized(straight(spark, sf)).select("sheet_id", "line_ix", "x1", "y1", "x2", "y2")


def symbols(spark, sf):
    return d.normalized(d.symbols(spark, sf))


def texts(spark, sf):
    return d.normalized(d.texts(spark, sf))


_GAP = "sqrt(pow(greatest({a}x1-{b}x2,{b}x1-{a}x2,0),2)+pow(greatest({a}y1-{b}y2,{b}y1-{a}y2,0),2))"
_LN = """, ln as (select sheet_id, line_ix, case when axis='h' then lo else pos end/4000.0 as x1, case when axis='h' then pos else lo end/3000.0 as y1, case when axis='h' then hi else pos end/4000.0 as x2, case when axis='h' then pos else hi end/3000.0 as y2 from segments),
lx as (select *, round_even(case when x1=x2 then x1 else greatest(x1-0.2,0) end,5) as ex1, round_even(case when x1=x2 then greatest(y1-0.2,0) else y1 end,5) as ey1, round_even(case when x1=x2 then x2 else least(x2+0.2,1) end,5) as ex2, round_even(case when x1=x2 then least(y2+0.2,1) else y2 end,5) as ey2 from ln),
sy as (select sheet_id, symbol_id as node, 'symbol' as type, 0 as phase, 12/4000.0 as lim, x1/4000.0 as x1, y1/3000.0 as y1, x2/4000.0 as x2, y2/3000.0 as y2 from symbols),
tx as (select sheet_id, text_ix as node, 'text' as type, 1 as phase, 5/4000.0 as lim, x1/4000.0 as x1, y1/3000.0 as y1, x2/4000.0 as x2, y2/3000.0 as y2 from texts),
hit0 as (select l.sheet_id, l.line_ix, b.node, b.type, b.phase, b.lim, sqrt(pow(greatest(b.x1-l.x1,l.x1-b.x2,0),2)+pow(greatest(b.y1-l.y1,l.y1-b.y2,0),2)) as ds, sqrt(pow(greatest(b.x1-l.x2,l.x2-b.x2,0),2)+pow(greatest(b.y1-l.y2,l.y2-b.y2,0),2)) as de,
  sqrt(pow(greatest(l.ex1-b.x2,b.x1-l.ex2,0),2)+pow(greatest(l.ey1-b.y2,b.y1-l.ey2,0),2)) as dx from lx l join (select * from sy union all select * from tx) b using (sheet_id)),
hits as (select sheet_id, line_ix, case when ds<=de then 'start' else 'end' end as side, node, type, phase, least(ds,de) as distance from hit0 where least(ds,de) <= lim and dx <= 5/4000.0)"""


def _hits(spark, sf, which):
    args = {"symbol": (symbols(spark, sf), "symbol_id", "symbol", 0, 12 / UNIT), "text": (texts(spark, sf), "text_ix", "text", 1, 5 / UNIT)}[which]
    return c.near_boxes(lines(spark, sf), *args, 5 / UNIT, 0.2, CELL)


@query("j01_line_symbol", f"{_LN} select sheet_id, line_ix, side, node, round(distance,7) as distance from hits where type='symbol'")
def j01(spark, sf):
    return _hits(spark, sf, "symbol").select("sheet_id", "line_ix", "side", "node", F.round("distance", 7).alias("distance"))


@query("j02_line_text", f"{_LN} select sheet_id, line_ix, side, node, round(distance,7) as distance from hits where type='text'")
def j02(spark, sf):
    return _hits(spark, sf, "text").select("sheet_id", "line_ix", "side", "node", F.round("distance", 7).alias("distance"))


@query("a01_first_holders", f"{_LN} select sheet_id, line_ix, side, node, type, round(distance,7) as distance from hits qualify row_number() over (partition by sheet_id, line_ix, side order by distance, phase, node) = 1")
def a01(spark, sf):
    return c.first_holders(_hits(spark, sf, "symbol"), _hits(spark, sf, "text")).select("sheet_id", "line_ix", "side", "node", "type", F.round("distance", 7).alias("distance"))


_LL = f"""{_LN.split(', sy as')[0].rstrip().rstrip(',')}, f0 as (select l.sheet_id, l.line_ix, q.line_ix as target,
 least(sqrt(pow(l.x1-q.x1,2)+pow(l.y1-q.y1,2)),sqrt(pow(l.x1-q.x2,2)+pow(l.y1-q.y2,2))) as sp, least(sqrt(pow(l.x2-q.x1,2)+pow(l.y2-q.y1,2)),sqrt(pow(l.x2-q.x2,2)+pow(l.y2-q.y2,2))) as ep,
 sqrt(pow(greatest(q.x1-l.x1,l.x1-q.x2,0),2)+pow(greatest(q.y1-l.y1,l.y1-q.y2,0),2)) as sl, sqrt(pow(greatest(q.x1-l.x2,l.x2-q.x2,0),2)+pow(greatest(q.y1-l.y2,l.y2-q.y2,0),2)) as el,
 sqrt(pow(greatest(l.ex1-q.ex2,q.ex1-l.ex2,0),2)+pow(greatest(l.ey1-q.ey2,q.ey1-l.ey2,0),2)) as dx from lx l join lx q using (sheet_id) where l.line_ix <> q.line_ix and abs(least(abs(l.x1-q.x1),abs(l.x1-q.x2),abs(l.x2-q.x1),abs(l.x2-q.x2), case when (q.x1-0.0125<=l.x1 and l.x1<=q.x2+0.0125) or (q.x1-0.0125<=l.x2 and l.x2<=q.x2+0.0125) then 0 else 1 end)) <= 0.0126)"""


@query("j03_line_line", f"{_LL} select sheet_id, line_ix, target, round(sp,6) as sp, round(ep,6) as ep, round(sl,6) as sl, round(el,6) as el from f0 where least(sl,el) < 50/4000.0 and dx <= 10/4000.0")
def j03(spark, sf):
    n = c.near_lines(lines(spark, sf), 50 / UNIT, 5 / UNIT, 0.2, CELL)
    return n.select("sheet_id", "line_ix", "target", *[F.round(x, 6).alias(x) for x in ("sp", "ep", "sl", "el")])


@query("j04_ray_hits", """, e as (select sheet_id, line_ix, side, case when axis='h' then (case side when 'start' then lo else hi end) else pos end/4000.0 as px, case when axis='h' then pos else (case side when 'start' then lo else hi end) end/3000.0 as py, axis from segments, (select unnest(['start','end']) as side) where hi > lo),
h as (select e.sheet_id, line_ix, side, symbol_id as node, case when axis='h' then (case when py<y1/3000.0 or py>y2/3000.0 then null when side='start' then (case when x1/4000.0>px then null else greatest(0,px-x2/4000.0) end) else (case when x2/4000.0<px then null else greatest(0,x1/4000.0-px) end) end)
 else (case when px<x1/4000.0 or px>x2/4000.0 then null when side='start' then (case when y1/3000.0>py then null else greatest(0,py-y2/3000.0) end) else (case when y2/3000.0<py then null else greatest(0,y1/3000.0-py) end) end) end as distance from e join symbols s on e.sheet_id=s.sheet_id)
select sheet_id, line_ix, side, node, round(distance,7) as distance from h where distance <= 60/4000.0 qualify row_number() over (partition by sheet_id, line_ix, side order by distance, node)=1""")
def j04(spark, sf):
    return c.ray_hits(lines(spark, sf), symbols(spark, sf), 60 / UNIT, CELL).withColumn("distance", F.round("distance", 7))


def candidate_table(spark, sf):
    return c.candidates(lines(spark, sf), symbols(spark, sf), texts(spark, sf), UNIT)


@query("h01_candidates")
def h01(spark, sf):
    return candidate_table(spark, sf).withColumn("distance", F.round("distance", 7))


@query("gr01_nodes", "select sheet_id, 'l-' || line_ix as node, 'line' as kind from segments union all select sheet_id, 's-' || symbol_id, 'symbol' from symbols")
def gr01(spark, sf):
    l = d.segments(spark, sf).select("sheet_id", t.node_id("l", F.col("line_ix")).alias("node"), F.lit("line").alias("kind"))
    return l.union(d.symbols(spark, sf).select("sheet_id", t.node_id("s", F.col("symbol_id")), F.lit("symbol")))


#: Edges of the holders alone (symbols and texts), which SQL can follow.
_EDGES = _LN + ", best as (select * from hits qualify row_number() over (partition by sheet_id, line_ix, side order by distance, phase, node) = 1), ed as (select sheet_id, 'l-' || line_ix as a, case type when 'symbol' then 's-' else 'l-t-' end || node as b, row_number() over (partition by sheet_id order by line_ix, side desc) - 1 as ord from best), two as (select distinct sheet_id, a, b from ed union select distinct sheet_id, b, a from ed)"


def holder_edges(spark, sf):
    return gr.edges_of(c.first_holders(_hits(spark, sf, "symbol"), _hits(spark, sf, "text")))


@query("gr02_edges", f"{_EDGES} select sheet_id, a, b, ord from ed")
def gr02(spark, sf):
    return holder_edges(spark, sf)


@query("gr04_neighbours", f"{_EDGES} select sheet_id, a as node, string_agg(b, ',' order by b) as neighbours from two group by sheet_id, a")
def gr04(spark, sf):
    return gr.both_ways(holder_edges(spark, sf)).groupBy("sheet_id", F.col("a").alias("node")).agg(F.array_join(F.array_sort(F.collect_list("b")), ",").alias("neighbours"))


@query("ag01_degrees", f"{_EDGES} select sheet_id, a as node, count(*) as degree from two group by sheet_id, a")
def ag01(spark, sf):
    return gr.degrees(holder_edges(spark, sf))


@query("ag02_junction_arrows", f"{_EDGES} select sheet_id, a as node, count(*) as degree, count(*) filter (starts_with(b,'l-')) as lines from two join (select sheet_id, 's-' || symbol_id as a from symbols where label = '{t.ARROW}') using (sheet_id, a) group by sheet_id, a having count(*) > 2 and count(*) filter (starts_with(b,'l-')) > 2")
def ag02(spark, sf):
    return gr.junction_arrows(holder_edges(spark, sf), d.symbols(spark, sf))




#: Pairs of near and aligned symbols of low degree, or equipment; {{only}} restricts the symbols.
_CLOSE = f"""{_EDGES}, deg as (select sheet_id, a as node, count(*) as degree from two group by all), low as (select s.* from symbols s left join deg on deg.sheet_id=s.sheet_id and deg.node='s-' || s.symbol_id where (coalesce(degree,0) < 2 or starts_with(label,'Equipment/')) and ({{{{only}}}})),
pr as (select a.sheet_id, a.symbol_id as a, b.symbol_id as b, a.x1 as ax1, a.y1 as ay1, a.x2 as ax2, a.y2 as ay2, b.x1 as bx1, b.y1 as by1, b.x2 as bx2, b.y2 as by2 from low a join low b on a.sheet_id=b.sheet_id and a.symbol_id<b.symbol_id)
select sheet_id, a, b from pr where {_GAP.format(a="a", b="b")} <= 40
 and ((ax1-20<=bx2+20 and bx1-20<=ax2+20 and ay1<=by2 and by1<=ay2 and least(ay2,by2)-greatest(ay1,by1) >= 0.7*40) or (ay1-20<=by2+20 and by1-20<=ay2+20 and ax1<=bx2 and bx1<=ax2 and least(ax2,bx2)-greatest(ax1,bx1) >= 0.7*40))"""


@query("j07_close_symbols", _CLOSE.replace("{{only}}", "true"))
def j07(spark, sf):
    return close_symbols(d.symbols(spark, sf), holder_edges(spark, sf), 40.0, 0.7, ("",), 200.0)


def close_symbols(symbols, edges, distance, share, prefixes, cell):
    """(a, b) with a < b: symbols of low degree, or equipment, that are near and aligned along an axis."""
    deg = gr.degrees(edges).select("sheet_id", F.col("node"), "degree")
    low = symbols.withColumn("node", t.node_id("s", F.col("symbol_id"))).join(deg, ["sheet_id", "node"], "left").where((F.coalesce("degree", F.lit(0)) < 2) | F.col("label").startswith("Equipment/"))
    low = low.where(t.starts_with_any(F.col("label"), prefixes))
    side = lambda p, n: low.select("sheet_id", F.col("symbol_id").alias(n), *[F.col(k).cast("double").alias(f"{p}{k}") for k in ("x1", "y1", "x2", "y2")])
    a, b = g.box("_a_"), g.box("_b_")
    met = box_join(side("_a_", "a"), side("_b_", "b"), KEY, tuple(a), tuple(b), distance, cell).where("a < b")
    ok = F.lit(False)
    for axis, other in (("h", "v"), ("v", "h")):
        pa, pb = g.padded(a, distance, axis), g.padded(b, distance, axis)
        ok = ok | (g.touches(pa, pb) & g.axis_overlap(pa, pb, other, share))
    return met.where((g.gap(a, b) <= distance) & ok).select("sheet_id", "a", "b")


_PROCESS = "starts_with(label,'Equipment/') or starts_with(label,'Instrument/')"


@query("gr03_close_edges", _CLOSE.replace("{{only}}", _PROCESS).replace("select sheet_id, a, b from pr", "select sheet_id, 's-' || a as a, 's-' || b as b, 'l-s-' || a || '-s-' || b as node from pr"))
def gr03(spark, sf):
    p = close_symbols(d.symbols(spark, sf), holder_edges(spark, sf), 40.0, 0.7, ("Equipment/", "Instrument/"), 200.0)
    a, b = t.node_id("s", F.col("a")), t.node_id("s", F.col("b"))
    return p.select("sheet_id", a.alias("a"), b.alias("b"), F.concat(F.lit("l-"), a, F.lit("-"), b).alias("node"))


@query("gr05_arrow_directions")
def gr05(spark, sf):
    l = lines(spark, sf)
    e = g.extended(g.box(), 0.2)
    l = l.withColumns({"ex1": e.x1, "ey1": e.y1, "ex2": e.x2, "ey2": e.y2})
    return gr.arrow_directions(holder_edges(spark, sf), symbols(spark, sf), l)


@query("j08_arrow_lines", f"{_EDGES} select sheet_id, a as arrow, b as line from two join (select sheet_id, 's-' || symbol_id as a from symbols where label = '{t.ARROW}') using (sheet_id, a) where regexp_matches(b, '^l-[0-9]+$')")
def j08(spark, sf):
    arrows = d.symbols(spark, sf).where(F.col("label") == t.ARROW).select("sheet_id", t.node_id("s", F.col("symbol_id")).alias("a"))
    return gr.both_ways(holder_edges(spark, sf)).where(F.col("b").rlike("^l-[0-9]+$")).join(arrows, ["sheet_id", "a"], "left_semi").select("sheet_id", F.col("a").alias("arrow"), F.col("b").alias("line"))


@query("gr06_assets", f"select sheet_id, symbol_id, coalesce(label<>'{t.ARROW}' and regexp_matches(text_associated,'[a-zA-Z]') and regexp_matches(text_associated,'[0-9]') and (starts_with(label,'Equipment/') or starts_with(label,'Instrument/')), false) as is_asset, coalesce(label<>'{t.ARROW}' and regexp_matches(text_associated,'[a-zA-Z]') and regexp_matches(text_associated,'[0-9]') and starts_with(label,'Instrument/Valve/'), false) as is_valve, text_associated is not null and starts_with(label,'Equipment/') as is_flow from symbols")
def gr06(spark, sf):
    return gr.assets(d.symbols(spark, sf), every=False).select("sheet_id", "symbol_id", "is_asset", "is_valve", "is_flow")


def _graph(spark, sf):
    """edges, assets and arrow sources of the candidate graph."""
    from sheetgraph.plans.stages import stash

    found = stash(candidate_table(spark, sf), "candidates")
    edges = gr.edges_of(found)
    l = lines(spark, sf)
    e = g.extended(g.box(), 0.2)
    arrows = gr.arrow_directions(edges, symbols(spark, sf), l.withColumns({"ex1": e.x1, "ey1": e.y1, "ex2": e.x2, "ey2": e.y2}))
    sources = arrows.where("source is not null").select("sheet_id", t.node_id("s", F.col("symbol_id")).alias("node"), "source")
    return edges, gr.assets(d.symbols(spark, sf)), stash(sources, "sources")


def _nodes(assets, flag):
    return assets.where(flag).select("sheet_id", t.node_id("s", F.col("symbol_id")).alias("node"))


@query("gr07_traversal")
def gr07(spark, sf):
    edges, assets, sources = _graph(spark, sf)
    return gr.traverse(edges, _nodes(assets, "is_asset"), _nodes(assets, "is_asset"), sources, paths=False)


def propagated(spark, sf):
    edges, assets, sources = _graph(spark, sf)
    junctions = gr.junction_arrows(edges, d.symbols(spark, sf)).select("sheet_id", "node")
    walks = gr.traverse(edges, _nodes(assets, "is_flow"), _nodes(assets, "is_asset and not is_valve"), sources, junctions)
    ends = _nodes(assets, "is_flow").union(junctions).distinct()
    return gr.carried_sources(walks.join(ends, ["sheet_id", "node"], "left_semi").select("sheet_id", "start", "node", "flow", "path")), edges, assets, sources


@query("gr08_carried_sources")
def gr08(spark, sf):
    return propagated(spark, sf)[0]


@query("gr09_published_sources", """, temp as (select distinct sheet_id, symbol_id % 20 as node, symbol_id % 7 as source from symbols) select * from temp t where exists (select 1 from temp u where u.sheet_id=t.sheet_id and u.node=t.node and not exists (select 1 from temp v where v.sheet_id=u.sheet_id and v.node=u.source and v.source=u.node))""")
def gr09(spark, sf):
    temp = d.symbols(spark, sf).select("sheet_id", (F.col("symbol_id") % 20).alias("node"), (F.col("symbol_id") % 7).alias("source")).distinct()
    return gr.published_sources(temp)


@query("gr09_published_of_carried")
def gr09_carried(spark, sf):
    """The sources that the propagation of flow leaves, from what it carried."""
    return gr.published_sources(propagated(spark, sf)[0])


@query("gr10_connected_assets")
def gr10(spark, sf):
    temp, edges, assets, sources = propagated(spark, sf)
    every = sources.unionByName(gr.published_sources(temp)).distinct()
    return gr.traverse(edges, _nodes(assets, "is_asset"), _nodes(assets, "is_asset"), every, paths=False)


@query("gr11_connections")
def gr11(spark, sf):
    edges, assets, sources = _graph(spark, sf)
    n = lambda kind, key, df: df.select("sheet_id", t.node_id(kind, F.col(key)).alias("node"), "x1", "y1", "x2", "y2")
    boxes = n("l", "line_ix", lines(spark, sf)).union(n("l-t", "text_ix", texts(spark, sf))).union(n("s", "symbol_id", symbols(spark, sf)))
    return gr.connections(edges, _nodes(assets, "is_asset"), _nodes(assets, "is_asset"), sources, assets.join(symbols(spark, sf).select("sheet_id", "symbol_id"), ["sheet_id", "symbol_id"]), boxes).select("sheet_id", "node", "label", "text", F.size("connections").alias("n"), F.to_json("connections").alias("connections"))


@query("gr15_reach_within", """, p as (select sheet_id, a_id as a, b_id as b from pairs), e as (select sheet_id, a, b from p union select sheet_id, b, a from p), hold as (select sheet_id, symbol_id as n, case when symbol_id % 4 = 0 then 1 else 0 end as cost from symbols),
w(sheet_id, n, depth, len) as (select sheet_id, symbol_id, 0, 0 from symbols where symbol_id % 60 = 0 union select w.sheet_id, e.b, w.depth + h.cost, w.len + 1 from w join e on w.sheet_id=e.sheet_id and w.n=e.a join hold h on h.sheet_id=e.sheet_id and h.n=e.b where w.depth + h.cost <= 2 and w.len < 12)
select sheet_id, n as point_id, min(depth) as depth from w group by sheet_id, n""")
def gr15(spark, sf):
    s, p = d.symbols(spark, sf), d.pairs(spark, sf)
    point = lambda cond: s.where(cond).select("sheet_id", F.col("symbol_id").alias("point_id"))
    return gr.reach_within(p.select("sheet_id", F.col("a_id").alias("a"), F.col("b_id").alias("b")), point("symbol_id % 4 = 0"), point("symbol_id % 60 = 0"), 2)


@query("gr18_display_edges", f"{_EDGES} select sheet_id, a, b from two join (select sheet_id, 's-' || symbol_id as a from symbols where starts_with(label,'Equipment/') or starts_with(label,'Instrument/')) using (sheet_id, a)")
def gr18(spark, sf):
    shown = d.symbols(spark, sf).where(t.starts_with_any(F.col("label"), ("Equipment/", "Instrument/"))).select("sheet_id", t.node_id("s", F.col("symbol_id")).alias("a"))
    return gr.both_ways(holder_edges(spark, sf)).join(shown, ["sheet_id", "a"], "left_semi").select("sheet_id", "a", "b")


# --- greedy


def _enlarged(spark, sf, m):
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", *[(F.col(k) + (m if k[1] == "2" else -m)).cast("double").alias(k) for k in ("x1", "y1", "x2", "y2")])


def overlaps(a, b, metric, least, cell=200.0):
    """Pairs (a_id, b_id, value) of two tables (sheet_id, id, box) whose metric is over `least`."""
    side = lambda df, p: df.select("sheet_id", F.col(df.columns[1]).alias(f"{p}_id"), *[F.col(k).alias(f"_{p}{k}") for k in ("x1", "y1", "x2", "y2")])
    x, y = g.box("_a"), g.box("_b")
    a_, b_ = side(a, "a"), side(b, "b")
    rename = {f"_{p}{k}": f"_{p}_{k}" for p in "ab" for k in ("x1", "y1", "x2", "y2")}
    a_, b_ = (q.withColumnsRenamed({k: v for k, v in rename.items() if k in q.columns}) for q in (a_, b_))
    x, y = g.box("_a_"), g.box("_b_")
    return box_join(a_, b_, KEY, tuple(x), tuple(y), 0.0, cell).withColumn("value", metric(x, y)).where(F.col("value") > least).select("sheet_id", "a_id", "b_id", "value")


_BIG = "big as (select sheet_id, symbol_id as id, x1-60 as x1, y1-60 as y1, x2+60 as x2, y2+60 as y2 from symbols)"
_OV = "greatest(0,least(a.x2,b.x2)-greatest(a.x1,b.x1))*greatest(0,least(a.y2,b.y2)-greatest(a.y1,b.y1))"


@query("j16_overlapping_detections", f", {_BIG} select a.sheet_id, a.id as a_id, b.id as b_id, round({_OV}/(160*160*2-{_OV}),6) as iou from big a join big b on a.sheet_id=b.sheet_id and a.id<b.id where {_OV}/(160*160*2-{_OV}) > 0.2")
def j16(spark, sf):
    b = _enlarged(spark, sf, 60)
    return overlaps(b, b, g.iou, 0.2).where("a_id < b_id").select("sheet_id", "a_id", "b_id", F.round("value", 6).alias("iou"))


def _scan(items: str, test: str, out: str) -> str:
    """SQL of the sequential scan over items (sheet_id, id, k in the order of the scan): each is kept unless it conflicts with one kept before.

    `test` tells of an earlier a and a later b; `out` selects from kept_ (sheet_id, id).
    """
    return f""", {items}, conf as materialized (select a.sheet_id, b.id as later, list(a.id) as es from it a join it b on a.sheet_id=b.sheet_id and a.k<b.k where {test} group by a.sheet_id, b.id),
scan_ as (select distinct sheet_id, cast(0 as bigint) as k, cast([] as bigint[]) as kept from it union all select s.sheet_id, i.k, case when c.es is not null and list_has_any(c.es, s.kept) then s.kept else list_append(s.kept, i.id) end from scan_ s join it i on i.sheet_id=s.sheet_id and i.k=s.k+1 left join conf c on c.sheet_id=i.sheet_id and c.later=i.id),
kept_ as (select sheet_id, unnest(kept) as id from scan_ qualify row_number() over (partition by sheet_id order by k desc) = 1)
{out}"""


def stroke_copies(spark, sf):
    """Segments, and for every fifth a shorter one three pixels beside it, as the two edges of a stroke give."""
    l = d.lines(spark, sf).select("sheet_id", "line_ix", "x1", "y1", "x2", "y2")
    part = lambda a, b: F.col(a) + 0.6 * (F.col(b) - F.col(a)) + 3
    return l.unionByName(l.where("line_ix % 5 = 0").select("sheet_id", (F.col("line_ix") + 1_000_000).alias("line_ix"), (F.col("x1") + 3).alias("x1"), (F.col("y1") + 3).alias("y1"), part("x1", "x2").alias("x2"), part("y1", "y2").alias("y2")))


_STROKES = """st as (select sheet_id, line_ix as id, x1, y1, x2, y2 from lines union all select sheet_id, line_ix + 1000000, x1+3, y1+3, x1+0.6*(x2-x1)+3, y1+0.6*(y2-y1)+3 from lines where line_ix % 5 = 0),
it as materialized (select *, case when n > 0 then (x2-x1)/n else 0 end as ux, case when n > 0 then (y2-y1)/n else 0 end as uy, ((degrees(atan2(y2-y1,x2-x1)) % 180) + 180) % 180 as turn, row_number() over (partition by sheet_id order by n desc, id) as k from (select *, sqrt(pow(x2-x1,2)+pow(y2-y1,2)) as n from st))"""
_ON = "(({x}-a.x1)*a.ux+({y}-a.y1)*a.uy)"
_OFF = "abs(({x}-a.x1)*a.uy-({y}-a.y1)*a.ux) <= 5"
_A, _B = _ON.format(x="b.x1", y="b.y1"), _ON.format(x="b.x2", y="b.y2")
_DUPLICATE = f"b.n > 0 and least(abs(a.turn-b.turn), 180-abs(a.turn-b.turn)) <= 10 and {_OFF.format(x='b.x1', y='b.y1')} and {_OFF.format(x='b.x2', y='b.y2')} and (least(a.n, greatest({_A},{_B})) - greatest(0, least({_A},{_B}))) / b.n >= 0.25"


@query("g01_kept_segments", _scan(_STROKES, _DUPLICATE, "select sheet_id, id as line_ix from kept_"))
def g01(spark, sf):
    from sheetgraph.operators import lines as ln

    return ln.deduplicated(stroke_copies(spark, sf), KEY).select("sheet_id", "line_ix")


def scored(spark, sf):
    """Symbols with boxes of four sizes and a score."""
    m = 40 + 20 * (F.col("symbol_id") % 4)
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", (0.5 + (F.col("symbol_id") * 7 % 10) / 20).alias("score"), *[(F.col(k) + (m if k[1] == "2" else -m)).cast("double").alias(k) for k in ("x1", "y1", "x2", "y2")])


_SCORED = "it as materialized (select *, (x2-x1)*(y2-y1) as area, row_number() over (partition by sheet_id order by score desc, id) as k from (select sheet_id, symbol_id as id, 0.5 + (symbol_id*7 % 10)/20.0 as score, x1-(40+20*(symbol_id%4)) as x1, y1-(40+20*(symbol_id%4)) as y1, x2+(40+20*(symbol_id%4)) as x2, y2+(40+20*(symbol_id%4)) as y2 from symbols))"


def best_of(items, item, metric, least, order):
    """items kept by a scan in that order; a pair whose metric is over `least` keeps the earlier one only."""
    pairs = overlaps(items.select("sheet_id", item, "x1", "y1", "x2", "y2"), items.select("sheet_id", item, "x1", "y1", "x2", "y2"), metric, least).where("a_id < b_id")
    return gd.keep_best(items, pairs.withColumnsRenamed({"a_id": "one", "b_id": "other"}), KEY, item, order)


def by_score(items, item):
    return best_of(items.withColumn("_s", -F.col("score")), item, g.iou, 0.5, ["_s", item])


@query("g03_kept_symbols", _scan(_SCORED, f"{_OV}/(a.area+b.area-{_OV}) > 0.5", "select sheet_id, id as symbol_id, row_number() over (partition by sheet_id order by y1, x1, k) - 1 as new_id from kept_ join it using (sheet_id, id)"))
def g03(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("sheet_id").orderBy("y1", "x1", F.desc("score"), "symbol_id")
    return by_score(scored(spark, sf), "symbol_id").select("sheet_id", "symbol_id", (F.row_number().over(w) - 1).alias("new_id"))


@query("g04_no_overlap", _scan(_SCORED, f"{_OV} > 0", "select sheet_id, id as symbol_id from kept_"))
def g04(spark, sf):
    return best_of(scored(spark, sf).withColumn("_s", -F.col("score")), "symbol_id", g.iou, 0.0, ["_s", "symbol_id"]).select("sheet_id", "symbol_id")


def of_tiles(spark, sf):
    """Symbols (odd ids) and texts (even ids) that tiles report, some twice."""
    s = scored(spark, sf).select("sheet_id", (2 * F.col("symbol_id") + 1).alias("item_id"), "score", "x1", "y1", "x2", "y2")
    x = d.texts(spark, sf).select("sheet_id", (4 * F.col("text_ix")).alias("item_id"), F.lit(None).cast("double").alias("score"), *[F.col(k).cast("double").alias(k) for k in ("x1", "y1", "x2", "y2")])
    again = x.where("item_id % 12 = 0").select("sheet_id", (F.col("item_id") + 2).alias("item_id"), "score", (F.col("x1") + 9).alias("x1"), "y1", (F.col("x2") + 9).alias("x2"), "y2")
    return s, x.unionByName(again)


_TILES = """tl as (select sheet_id, 2*symbol_id+1 as id, 0.5 + (symbol_id*7 % 10)/20.0 as score, x1-(40+20*(symbol_id%4)) as x1, y1-(40+20*(symbol_id%4)) as y1, x2+(40+20*(symbol_id%4)) as x2, y2+(40+20*(symbol_id%4)) as y2 from symbols
 union all select sheet_id, 4*text_ix, 0.5, x1, y1, x2, y2 from texts union all select sheet_id, 4*text_ix+2, 0.5, x1+9, y1, x2+9, y2 from texts where text_ix % 3 = 0),
it as materialized (select *, (x2-x1)*(y2-y1) as area, row_number() over (partition by sheet_id order by id % 2 desc, score desc, id) as k from tl)"""


@query("g05_kept_of_tiles", _scan(_TILES, f"a.id%2=b.id%2 and case when a.id%2=1 then {_OV}/least(a.area,b.area) > 0.5 else {_OV}/(a.area+b.area-{_OV}) > 0.4 end", "select sheet_id, case when id%2=1 then 'symbol' else 'text' end as kind, id as item_id from kept_"))
def g05(spark, sf):
    s, x = of_tiles(spark, sf)
    kept = best_of(s.withColumn("_s", -F.col("score")), "item_id", g.overlap_of_smaller, 0.5, ["_s", "item_id"]).select("sheet_id", F.lit("symbol").alias("kind"), "item_id")
    return kept.unionByName(best_of(x, "item_id", g.iou, 0.4, ["item_id"]).select("sheet_id", F.lit("text").alias("kind"), "item_id"))


@query("g02_matched", f""", {_BIG}, pr as (select a.sheet_id, a.id as a_id, b.id as b_id, {_OV}/(51200.0-{_OV}) as iou, row_number() over (partition by a.sheet_id order by {_OV}/(51200.0-{_OV}) desc, a.id, b.id) as k from big a join big b on a.sheet_id=b.sheet_id and a.id%2=0 and b.id%2=1 where {_OV}/(51200.0-{_OV}) > 0.05),
scan_ as (select distinct sheet_id, cast(0 as bigint) as k, cast([] as bigint[]) as used, false as took, cast(null as bigint) as a_id, cast(null as bigint) as b_id, cast(null as double) as iou from pr union all select s.sheet_id, p.k, case when list_contains(s.used,p.a_id) or list_contains(s.used,p.b_id) then s.used else list_concat(s.used,[p.a_id,p.b_id]) end, not (list_contains(s.used,p.a_id) or list_contains(s.used,p.b_id)), p.a_id, p.b_id, p.iou from scan_ s join pr p on p.sheet_id=s.sheet_id and p.k=s.k+1)
select sheet_id, a_id, b_id, round(iou,6) as iou from scan_ where took""")
def g02(spark, sf):
    b = _enlarged(spark, sf, 60)
    p = overlaps(b.where("symbol_id % 2 = 0"), b.where("symbol_id % 2 = 1"), g.iou, 0.05)
    return gd.match_greedily(p, KEY, "a_id", "b_id", [-F.col("value")]).select("sheet_id", "a_id", "b_id", F.round("value", 6).alias("iou"))


@query("f07_mapped_symbols", "select sheet_id, symbol_id, row_number() over (partition by sheet_id order by symbol_id) - 1 as new_id from symbols where symbol_id % 4 <> 3")
def f07(spark, sf):
    from pyspark.sql import Window

    from sheetgraph.operators import tags as tg

    classes = F.element_at(F.array(F.lit("Gate_Valve"), F.lit("box"), F.lit("Reducer"), F.lit("Not_used")), (F.col("symbol_id") % 4 + 1).cast("int"))
    kept = tg.with_label(d.symbols(spark, sf).drop("label").withColumn("class", classes), "class").where("label is not null")
    return kept.select("sheet_id", "symbol_id", (F.row_number().over(Window.partitionBy("sheet_id").orderBy("symbol_id")) - 1).alias("new_id"))


@query("f11_unmatched_new", f", {_BIG} select sheet_id, id as symbol_id from big b where id % 2 = 1 and not exists (select 1 from big a where a.sheet_id=b.sheet_id and a.id % 2 = 0 and {_OV}/(160*160*2-{_OV}) >= 0.3)")
def f11(spark, sf):
    b = _enlarged(spark, sf, 60)
    hit = overlaps(b.where("symbol_id % 2 = 1"), b.where("symbol_id % 2 = 0"), g.iou, 0.0).where("value >= 0.3").select("sheet_id", F.col("a_id").alias("symbol_id"))
    return b.where("symbol_id % 2 = 1").join(hit, ["sheet_id", "symbol_id"], "left_anti").select("sheet_id", "symbol_id")


@query("f12_containing_new", "select sheet_id, symbol_id from symbols b where symbol_id % 2 = 1 and exists (select 1 from symbols a where a.sheet_id=b.sheet_id and a.symbol_id % 2 = 0 and a.x1>=b.x1-62 and a.y1>=b.y1-62 and a.x2<=b.x2+62 and a.y2<=b.y2+62)")
def f12(spark, sf):
    new, old = _enlarged(spark, sf, 60).where("symbol_id % 2 = 1"), _enlarged(spark, sf, 0).where("symbol_id % 2 = 0")
    side = lambda df, p: df.select("sheet_id", F.col("symbol_id").alias(f"{p}_id"), *[F.col(k).alias(f"_{p}_{k}") for k in ("x1", "y1", "x2", "y2")])
    a, b = g.box("_a_"), g.box("_b_")
    met = box_join(side(new, "a"), side(old, "b"), KEY, tuple(a), tuple(b), 2.0, 200.0).where(g.inside(b, a, 2.0))
    return new.join(met.select("sheet_id", F.col("a_id").alias("symbol_id")), ["sheet_id", "symbol_id"], "left_semi").select("sheet_id", "symbol_id")


def association_pairs(spark, sf):
    """Symbols and texts of a sheet within the search margin, and their cost."""
    s = d.symbols(spark, sf).select("sheet_id", "symbol_id", *[F.col(k).cast("double").alias(f"_s{k}") for k in ("x1", "y1", "x2", "y2")])
    x = d.texts(spark, sf).select("sheet_id", "text_ix", "text", *[F.col(k).cast("double").alias(f"_t{k}") for k in ("x1", "y1", "x2", "y2")])
    a, b = g.box("_s"), g.box("_t")
    met = box_join(s, x, KEY, tuple(a), tuple(b), 20.0, 200.0).where(g.overlap_area(g.expanded(a, 20.0), b) > 0)
    return met.select("sheet_id", "symbol_id", "text_ix", association_cost(a, b, F.col("text")).alias("cost"))


def association_cost(symbol, text_box, text):
    """Distance of the centres, the vertical part twice, less or more for enclosed, tag-like and longer texts."""
    (sx, sy), (tx, ty) = g.centre(symbol), g.centre(text_box)
    enclosed = F.when(g.contained_share(text_box, symbol) >= 0.75, -1000.0).otherwise(0.0)
    tag = F.when(t.is_equipment_tag(text), -200.0).otherwise(300.0)
    size = F.when(F.length(text) > 1, -600.0).otherwise(300.0)
    return F.hypot(tx - sx, ty - sy) + F.abs(ty - sy) + enclosed + tag + size


_COST = f"""select s.sheet_id, s.symbol_id, t.text_ix, sqrt(pow((t.x1+t.x2-s.x1-s.x2)/2.0,2)+pow((t.y1+t.y2-s.y1-s.y2)/2.0,2)) + abs((t.y1+t.y2-s.y1-s.y2)/2.0)
 + case when greatest(0,least(s.x2,t.x2)-greatest(s.x1,t.x1))*greatest(0,least(s.y2,t.y2)-greatest(s.y1,t.y1)) >= 0.75*(t.x2-t.x1)*(t.y2-t.y1) then -1000 else 0 end
 + case when regexp_matches(trim(regexp_replace(t.text,'\\s+',' ','g')),'{t.EQUIPMENT_TAG}') then -200 else 300 end + case when length(t.text)>1 then -600 else 300 end as cost
 from symbols s join texts t on s.sheet_id=t.sheet_id and s.x1-20<t.x2 and t.x1<s.x2+20 and s.y1-20<t.y2 and t.y1<s.y2+20"""


@query("j15_association_pairs", f"select sheet_id, symbol_id, text_ix, round(cost,6) as cost from ({_COST})")
def j15(spark, sf):
    return association_pairs(spark, sf).withColumn("cost", F.round("cost", 6))


@query("g07_least_costs", f"select sheet_id, symbol_id, round(min(cost),6) as cost, count(*) as n from ({_COST}) group by sheet_id, symbol_id")
def g07(spark, sf):
    return association_pairs(spark, sf).groupBy("sheet_id", "symbol_id").agg(F.round(F.min("cost"), 6).alias("cost"), F.count("*").alias("n"))


@query("g06_assigned")
def g06(spark, sf):
    return gd.assign(association_pairs(spark, sf), KEY, "symbol_id", "text_ix", "cost", -500.0).withColumn("cost", F.round("cost", 6))


def claimed_texts(spark, sf):
    s = d.symbols(spark, sf).select("sheet_id", "symbol_id", F.trim("text_associated").alias("tag"), *[F.col(k).cast("double").alias(f"_s{k}") for k in ("x1", "y1", "x2", "y2")]).where("tag <> ''")
    x = d.texts(spark, sf).select("sheet_id", F.trim("text").alias("tag"), "text_ix", *[F.col(k).cast("double").alias(f"_t{k}") for k in ("x1", "y1", "x2", "y2")])
    p = s.join(x, ["sheet_id", "tag"]).select("sheet_id", "tag", "symbol_id", "text_ix", g.gap(g.box("_s"), g.box("_t")).alias("distance"))
    return gd.claim_nearest(p, ["sheet_id", "tag"], "symbol_id", "text_ix", "distance")


_CLAIM = """, cand as (select s.sheet_id, s.text_associated as tag, s.symbol_id, list(struct_pack(d := sqrt(pow(greatest(s.x1-t.x2,t.x1-s.x2,0),2)+pow(greatest(s.y1-t.y2,t.y1-s.y2,0),2)), t := t.text_ix) order by sqrt(pow(greatest(s.x1-t.x2,t.x1-s.x2,0),2)+pow(greatest(s.y1-t.y2,t.y1-s.y2,0),2)), t.text_ix) as near_, row_number() over (partition by s.sheet_id, s.text_associated order by s.symbol_id) as k from symbols s join texts t on s.sheet_id=t.sheet_id and s.text_associated=t.text group by s.sheet_id, s.text_associated, s.symbol_id),
claim as (select distinct sheet_id, tag, cast(0 as bigint) as k, cast([] as bigint[]) as used, cast(null as bigint) as symbol_id, cast(null as struct(d double, t bigint)) as got from cand union all select sheet_id, tag, k, case when got is null then used else list_append(used, got.t) end, symbol_id, got from (select c.sheet_id, c.tag, c.k, m.used, c.symbol_id, list_filter(c.near_, lambda x: not list_contains(m.used, x.t))[1] as got from claim m join cand c on c.sheet_id=m.sheet_id and c.tag=m.tag and c.k=m.k+1))"""


@query("j05_claimed_texts", f"{_CLAIM} select sheet_id, tag, symbol_id, got.t as text_ix, round(got.d,6) as distance from claim where got is not null")
def j05(spark, sf):
    return claimed_texts(spark, sf).withColumn("distance", F.round("distance", 6))


@query("f13_leftover_texts", f"{_CLAIM} select sheet_id, text_ix from texts t where not exists (select 1 from claim c where c.sheet_id=t.sheet_id and c.got is not null and c.got.t=t.text_ix)")
def f13(spark, sf):
    return d.texts(spark, sf).join(claimed_texts(spark, sf), ["sheet_id", "text_ix"], "left_anti").select("sheet_id", "text_ix")


#: Leftover texts and the open symbols and lines near them, taken nearest first: att(sheet_id, text_ix, kind, id, distance).
_ATTACHED = f"""{_CLAIM}, {_BOXED},
lt as (select * from texts t where trim(text) <> '' and not exists (select 1 from claim c where c.sheet_id=t.sheet_id and c.got is not null and c.got.t=t.text_ix)),
ow as (select distinct s.sheet_id, s.symbol_id from symbols s join texts q on q.sheet_id=s.sheet_id and trim(q.text)=trim(s.text_associated) and q.x1>=s.x1 and q.y1>=s.y1 and q.x2<=s.x2 and q.y2<=s.y2),
tg as (select sheet_id, 0 as kd, symbol_id as id, x1, y1, x2, y2 from symbols s where coalesce(trim(text_associated),'') = '' or exists (select 1 from ow where ow.sheet_id=s.sheet_id and ow.symbol_id=s.symbol_id)
 union all select sheet_id, 1, line_ix, x1, y1, x2, y2 from straight l where not exists (select 1 from texts t where t.sheet_id=l.sheet_id and t.x1<=l.x2 and l.x1<=t.x2 and t.y1<=l.y2 and l.y1<=t.y2) and not exists (select 1 from boxed b where b.sheet_id=l.sheet_id and b.line_ix=l.line_ix)),
nr as (select t.sheet_id, t.text_ix, g.kd, g.id, sqrt(pow(greatest(t.x1-g.x2,g.x1-t.x2,0),2)+pow(greatest(t.y1-g.y2,g.y1-t.y2,0),2)) as d from lt t join tg g on g.sheet_id=t.sheet_id and g.x1<=t.x2+10 and t.x1<=g.x2+10 and g.y1<=t.y2+10 and t.y1<=g.y2+10),
pr as materialized (select *, row_number() over (partition by sheet_id order by d, text_ix, kd, id) as k from nr where d <= 10),
sc as (select distinct sheet_id, cast(0 as bigint) as k, cast([] as bigint[]) as ut, cast([] as bigint[]) as ug, false as took, cast(null as bigint) as text_ix, cast(null as int) as kd, cast(null as bigint) as id, cast(null as double) as d from pr
 union all select sheet_id, k, case when free then list_append(ut, text_ix) else ut end, case when free then list_append(ug, 2*id+kd) else ug end, free, text_ix, kd, id, d from (select s.sheet_id, p.k, s.ut, s.ug, not (list_contains(s.ut, p.text_ix) or list_contains(s.ug, 2*p.id+p.kd)) as free, p.text_ix, p.kd, p.id, p.d from sc s join pr p on p.sheet_id=s.sheet_id and p.k=s.k+1)),
att as (select sheet_id, text_ix, case kd when 0 then 'symbol' else 'line' end as kind, id, round(d,1) as distance from sc where took)"""


@query("j06_attached_texts", f"{_ATTACHED} select * from att")
def j06(spark, sf):
    left = f13(spark, sf)
    x = d.texts(spark, sf).join(left, ["sheet_id", "text_ix"]).where("trim(text) <> ''").select("sheet_id", "text_ix", *[F.col(k).cast("double").alias(f"_t{k}") for k in ("x1", "y1", "x2", "y2")])
    c4 = ("x1", "y1", "x2", "y2")
    sym = d.symbols(spark, sf)
    tagged = F.coalesce(F.trim("text_associated"), F.lit("")) != ""
    own = sym.where(tagged).select("sheet_id", "symbol_id", F.trim("text_associated").alias("tag"), *[F.col(k).alias(f"_s{k}") for k in c4]).join(d.texts(spark, sf).select("sheet_id", F.trim("text").alias("tag"), *[F.col(k).alias(f"_q{k}") for k in c4]), ["sheet_id", "tag"]).where(g.inside(g.box("_q"), g.box("_s"))).select("sheet_id", "symbol_id").distinct()
    open_symbols = sym.where(~tagged).select("sheet_id", "symbol_id", *c4).union(sym.join(own, ["sheet_id", "symbol_id"], "left_semi").select("sheet_id", "symbol_id", *c4))
    from sheetgraph.operators import lines as ln
    from sheetgraph.plans.crossings import boxes

    open_lines = ln.mark_boxed(ln.outside_texts(straight(spark, sf), d.texts(spark, sf), KEY), boxes(spark, sf), KEY).where("not boxed")
    target = open_symbols.select("sheet_id", F.lit("symbol").alias("kind"), F.col("symbol_id").alias("id"), *c4).union(open_lines.select("sheet_id", F.lit("line"), "line_ix", *c4))
    y = target.select("sheet_id", F.struct("kind", "id").alias("target"), *[F.col(k).cast("double").alias(f"_g{k}") for k in c4])
    p = box_join(x, y, KEY, tuple(g.box("_t")), tuple(g.box("_g")), 10.0, 200.0).withColumn("distance", g.gap(g.box("_t"), g.box("_g"))).where("distance <= 10").select("sheet_id", "text_ix", "target", "distance")
    # at equal distance: by text, symbols before lines, in their order
    m = gd.match_greedily(p, KEY, "text_ix", "target", ["distance", "text_ix", F.when(F.col("target.kind") == "symbol", 0).otherwise(1), F.col("target.id")])
    return m.select("sheet_id", "text_ix", "target.kind", "target.id", F.round("distance", 1).alias("distance"))
