"""Queries of the crossing graph and of the joins, windows and aggregates that it is made of."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sheetgraph.operators import crossing as x
from sheetgraph.operators import lines as ln
from sheetgraph.operators.components import connected_components
from sheetgraph.operators.spatial import islands
from sheetgraph.plans.registry import query
from sheetgraph.plans.stages import stash
from sheetgraph.sources import derived as d

KEY = ["sheet_id"]
_ENDS = "select sheet_id, line_ix, case when axis='h' then lo else pos end as x1, case when axis='h' then pos else lo end as y1, case when axis='h' then hi else pos end as x2, case when axis='h' then pos else hi end as y2 from segments"
_BOXES = "select sheet_id, x1, y1, x2, y2 from symbols union all select sheet_id, x1, y1, x2, y2 from texts"
_BOXED = f"straight as ({_ENDS}), boxes as ({_BOXES}), boxed as (select distinct l.sheet_id, l.line_ix from straight l join boxes b on l.sheet_id=b.sheet_id and l.x1>=b.x1 and l.y1>=b.y1 and l.x2<=b.x2 and l.y2<=b.y2)"
_RUNS = f""", {_BOXED},
frag as (select s.*, (pos+1)//20 as level, b.line_ix is not null as boxed from segments s left join boxed b using (sheet_id, line_ix)),
isl0 as (select *, case when lo - max(hi) over (partition by sheet_id, axis, level order by lo, line_ix rows between unbounded preceding and 1 preceding) <= 25 then 0 else 1 end as st from frag),
isl as (select *, sum(st) over (partition by sheet_id, axis, level order by lo, line_ix rows between unbounded preceding and current row) as island from isl0),
ids as (select *, min(line_ix) over (partition by sheet_id, axis, level, island) as run_id, row_number() over (partition by sheet_id, axis, level, island order by lo, hi, pos) as n from isl),
trim_ as (select *, min(case when not boxed then n end) over (partition by sheet_id, axis, run_id) as a, max(case when not boxed then n end) over (partition by sheet_id, axis, run_id) as b from ids),
runs as (select sheet_id, axis, run_id, min(lo) as lo, max(hi) as hi, sum(pos*(hi-lo+1))/sum(hi-lo+1) as pos, sum(hi-lo+1) as ink, count(*) as parts, count(*) filter (boxed) as bridged, 2*sum(case when line_type='dashed' then hi-lo+1 else 0 end) > sum(hi-lo+1) as dashed from trim_ where n between a and b group by sheet_id, axis, run_id)"""


def straight(spark, sf):
    s, h = d.segments(spark, sf), F.col("axis") == "h"
    pick = lambda a, b: F.when(h, F.col(a)).otherwise(F.col(b))
    return s.withColumns({"x1": pick("lo", "pos"), "y1": pick("pos", "lo"), "x2": pick("hi", "pos"), "y2": pick("pos", "hi")})


def boxes(spark, sf):
    c = ["sheet_id", "x1", "y1", "x2", "y2"]
    return d.symbols(spark, sf).select(*c).union(d.texts(spark, sf).select(*c))


def fragments(spark, sf):
    marked = ln.mark_boxed(straight(spark, sf), boxes(spark, sf), KEY)
    return marked.select("sheet_id", "axis", "pos", "lo", "hi", "line_ix", (F.col("line_type") == "dashed").alias("dashed"), "boxed")


def stitched(spark, sf):
    return x.runs_of(x.fragment_groups(fragments(spark, sf), KEY, 2.5, 25.0, "line_ix"), KEY)


def raw_runs(spark, sf):
    """Every segment as a run of its own."""
    return d.segments(spark, sf).select("sheet_id", "axis", F.col("line_ix").alias("run_id"), F.col("pos").cast("double").alias("pos"), F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi"))


@query("f04_boxed", f", {_BOXED} select l.sheet_id, l.line_ix, b.line_ix is not null as boxed from straight l left join boxed b using (sheet_id, line_ix)")
def f04(spark, sf):
    return ln.mark_boxed(straight(spark, sf), boxes(spark, sf), KEY).select("sheet_id", "line_ix", "boxed")


@query("f14_outside_texts", f", straight as ({_ENDS}) select sheet_id, line_ix from straight l where not exists (select 1 from texts t where t.sheet_id=l.sheet_id and t.x1<=l.x2 and l.x1<=t.x2 and t.y1<=l.y2 and l.y1<=t.y2)")
def f14(spark, sf):
    return ln.outside_texts(straight(spark, sf), d.texts(spark, sf), KEY).select("sheet_id", "line_ix")


@query("j11_fragment_groups", f"{_RUNS} select sheet_id, axis, line_ix, run_id as piece_of from ids")
def j11(spark, sf):
    return x.fragment_groups(fragments(spark, sf), KEY, 2.5, 25.0, "line_ix").select("sheet_id", "axis", "line_ix", "piece_of")


@query("l03_runs", f"{_RUNS} select sheet_id, axis, run_id, lo, hi, round(pos,6) as pos, cast(ink as bigint) as ink, parts, bridged, dashed from runs")
def l03(spark, sf):
    return stitched(spark, sf).withColumn("pos", F.round("pos", 6))


@query("ag03_run_totals", f"{_RUNS} select sheet_id, axis, run_id, lo, hi, round(pos,6) as pos, cast(ink as bigint) as ink, dashed from runs")
def ag03(spark, sf):
    return stitched(spark, sf).select("sheet_id", "axis", "run_id", "lo", "hi", F.round("pos", 6).alias("pos"), "ink", "dashed")


@query("ag04_trimmed_parts", f"{_RUNS} select sheet_id, axis, run_id, count(*) as all_parts, count(*) filter (n between a and b) as kept from trim_ group by all")
def ag04(spark, sf):
    g = x.fragment_groups(fragments(spark, sf), KEY, 2.5, 25.0, "line_ix")
    every = g.groupBy("sheet_id", "axis", F.col("piece_of").alias("run_id")).agg(F.count("*").alias("all_parts"))
    return every.join(x.runs_of(g, KEY).select("sheet_id", "axis", "run_id", F.col("parts").alias("kept")), ["sheet_id", "axis", "run_id"], "left").withColumn("kept", F.coalesce("kept", F.lit(0)))


@query("f09_outlines_dropped", f"{_RUNS} select sheet_id, axis, run_id from runs r where not exists (select 1 from symbols s where s.sheet_id=r.sheet_id and ((r.axis='h' and s.y1-40<=r.pos and r.pos<=s.y2+40 and s.x1-40<=r.lo and r.hi<=s.x2+40) or (r.axis='v' and s.x1-40<=r.pos and r.pos<=s.x2+40 and s.y1-40<=r.lo and r.hi<=s.y2+40)))")
def f09(spark, sf):
    return x.drop_outlines(stitched(spark, sf), d.symbols(spark, sf), KEY, 40.0).select("sheet_id", "axis", "run_id")


_CROSS = """select h.sheet_id, h.line_ix as h_id, v.line_ix as v_id, v.pos as x, h.pos as y from segments h join segments v on h.sheet_id=v.sheet_id and h.axis='h' and v.axis='v'
where v.pos >= h.lo - case when (v.pos<h.lo or v.pos>h.hi) and (h.pos<v.lo or h.pos>v.hi) then 20 else 4 end and v.pos <= h.hi + case when (v.pos<h.lo or v.pos>h.hi) and (h.pos<v.lo or h.pos>v.hi) then 20 else 4 end
and h.pos >= v.lo - case when (v.pos<h.lo or v.pos>h.hi) and (h.pos<v.lo or h.pos>v.hi) then 20 else 4 end and h.pos <= v.hi + case when (v.pos<h.lo or v.pos>h.hi) and (h.pos<v.lo or h.pos>v.hi) then 20 else 4 end"""


def raw_crossings(spark, sf):
    r = raw_runs(spark, sf)
    return x.crossings(r.where("axis = 'h'"), r.where("axis = 'v'"), KEY, 4.0, 20.0)


@query("j09_crossings", f"select sheet_id, h_id, v_id, cast(x as bigint) as x, cast(y as bigint) as y from ({_CROSS})")
def j09(spark, sf):
    return raw_crossings(spark, sf).select("sheet_id", "h_id", "v_id", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"))


@query("j10_contacts", """select sheet_id, axis, line_ix, symbol_id, unnest(case when lo < b_lo+3 and hi > b_hi-3 then list_distinct([a, b]) else [(a+b)/2.0] end) as at from
(select *, greatest(lo-9, b_lo-3) as a, least(hi+9, b_hi+3) as b from (select r.sheet_id, r.axis, r.line_ix, s.symbol_id, cast(r.lo as double) as lo, cast(r.hi as double) as hi, r.pos, cast(case when r.axis='h' then s.x1 else s.y1 end as double) as b_lo, cast(case when r.axis='h' then s.x2 else s.y2 end as double) as b_hi, case when r.axis='h' then s.y1 else s.x1 end as c_lo, case when r.axis='h' then s.y2 else s.x2 end as c_hi from segments r join symbols s using (sheet_id))
where pos between c_lo-3 and c_hi+3) where a <= b""")
def j10(spark, sf):
    return x.contacts(raw_runs(spark, sf), d.symbols(spark, sf), KEY, 3.0, 9.0).select("sheet_id", "axis", F.col("run_id").alias("line_ix"), "symbol_id", "at")


_ENTRIES = f"""{_RUNS}, met as (select h.sheet_id, h.run_id as h_id, v.run_id as v_id, v.pos as x, h.pos as y from runs h join runs v on h.sheet_id=v.sheet_id and h.axis='h' and v.axis='v'
where v.pos between h.lo - case when (v.pos<h.lo or v.pos>h.hi) and (h.pos<v.lo or h.pos>v.hi) then 20 else 4 end and h.hi + case when (v.pos<h.lo or v.pos>h.hi) and (h.pos<v.lo or h.pos>v.hi) then 20 else 4 end
and h.pos between v.lo - case when (v.pos<h.lo or v.pos>h.hi) and (h.pos<v.lo or h.pos>v.hi) then 20 else 4 end and v.hi + case when (v.pos<h.lo or v.pos>h.hi) and (h.pos<v.lo or h.pos>v.hi) then 20 else 4 end),
ent as (select sheet_id, 'h' as axis, h_id as run_id, x as at_, v_id as point_id from met union all select sheet_id, 'v', v_id, y, h_id from met)"""


def run_entries(spark, sf):
    """Where the runs of a sheet cross, as an entry of each of the two: (axis, run_id, at, point_id), points named by the other run."""
    runs = stash(stitched(spark, sf), "stitched")
    c = stash(x.crossings(runs.where("axis = 'h'"), runs.where("axis = 'v'"), KEY, 4.0, 20.0), "crossings")
    side = lambda axis, run, at, other: c.select("sheet_id", F.lit(axis).alias("axis"), F.col(run).alias("run_id"), F.col(at).alias("at"), F.col(other).alias("point_id"))
    return side("h", "h_id", "x", "v_id").unionByName(side("v", "v_id", "y", "h_id"))


@query("w01_chained_points", f"{_ENTRIES} select sheet_id, axis, run_id, round(at_, 6) as at, round(nx, 6) as next_at, round(nx - at_, 6) as length from (select *, lead(at_) over (partition by sheet_id, axis, run_id order by at_, point_id) as nx from ent) where nx is not null")
def w01(spark, sf):
    """Neighbouring crossings along each stitched run, of both axes."""
    return x.chain(run_entries(spark, sf)).select("sheet_id", "axis", "run_id", F.round("at", 6).alias("at"), F.round(F.col("at") + F.col("length"), 6).alias("next_at"), F.round("length", 6).alias("length"))


@query("ag15_run_support", f"{_ENTRIES} select sheet_id, axis, run_id, count(*) as entries from ent group by all having count(*) >= 2")
def ag15(spark, sf):
    return run_entries(spark, sf).groupBy("sheet_id", "axis", "run_id").agg(F.count("*").alias("entries")).where("entries >= 2")


@query("f05_unboxed_solid", f", {_BOXED} select s.sheet_id, s.line_ix, row_number() over (partition by s.sheet_id order by s.line_ix) - 1 as new_ix from segments s left join boxed b using (sheet_id, line_ix) where b.line_ix is null and s.line_type <> 'dashed'")
def f05(spark, sf):
    """Segments that go into the graph, neither boxed nor dashed, numbered anew."""
    kept = ln.mark_boxed(straight(spark, sf), boxes(spark, sf), KEY).where("not boxed and line_type <> 'dashed'")
    return kept.select("sheet_id", "line_ix", (F.row_number().over(Window.partitionBy("sheet_id").orderBy("line_ix")) - 1).alias("new_ix"))


@query("gr16_region_pick", f"{_RUNS}, mid as (select sheet_id, axis, run_id, case when axis='v' then pos else (lo+hi)/2.0 end as x, case when axis='h' then pos else (lo+hi)/2.0 end as y from runs) select sheet_id, axis, run_id from mid qualify x > median(x) over (partition by sheet_id) and y > median(y) over (partition by sheet_id)")
def gr16(spark, sf):
    """The runs whose middle lies right of and below the median of their sheet."""
    mid, v = (F.col("lo") + F.col("hi")) / 2, F.col("axis") == "v"
    r = stitched(spark, sf).select("sheet_id", "axis", "run_id", F.when(v, F.col("pos")).otherwise(mid).alias("x"), F.when(v, mid).otherwise(F.col("pos")).alias("y"))
    m = r.groupBy("sheet_id").agg(F.median("x").alias("mx"), F.median("y").alias("my"))
    return r.join(m, "sheet_id").where("x > mx and y > my").select("sheet_id", "axis", "run_id")


@query("gr16_scattered", f"{_RUNS} select sheet_id, axis, run_id from runs qualify row_number() over (partition by sheet_id order by md5(concat('7:', axis, ':', run_id)), axis, run_id) <= floor(count(*) over (partition by sheet_id) * 0.2)")
def gr16_scattered(spark, sf):
    """A fifth of each sheet's runs, rounded down, picked by a seeded hash."""
    return x.scattered(stash(stitched(spark, sf), "stitched"), KEY, ["axis", "run_id"], 0.2, 7).select("sheet_id", "axis", "run_id")


@query("w02_islands", "select sheet_id, axis, level, island, min(lo) as lo, max(hi) as hi, count(*) as n from (select *, sum(st) over (partition by sheet_id, axis, level order by lo, line_ix rows unbounded preceding) - 1 as island from (select *, (pos+1)//20 as level, case when lo - max(hi) over (partition by sheet_id, axis, (pos+1)//20 order by lo, line_ix rows between unbounded preceding and 1 preceding) <= 100 then 0 else 1 end as st from segments)) group by all")
def w02(spark, sf):
    s = d.segments(spark, sf).withColumn("level", F.floor((F.col("pos") + 1) / 20))
    return islands(s, ["sheet_id", "axis", "level"], "lo", "hi", 100, ties=["line_ix"]).groupBy("sheet_id", "axis", "level", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("n"))


@query("w03_interval_union", "select sheet_id, axis, pos, min(lo) as lo, max(hi) as hi from (select *, sum(st) over (partition by sheet_id, axis, pos order by lo, line_ix rows unbounded preceding) as island from (select *, case when lo - max(hi) over (partition by sheet_id, axis, pos order by lo, line_ix rows between unbounded preceding and 1 preceding) <= 8 then 0 else 1 end as st from segments)) group by sheet_id, axis, pos, island")
def w03(spark, sf):
    return islands(d.segments(spark, sf), ["sheet_id", "axis", "pos"], "lo", "hi", 8, ties=["line_ix"]).groupBy("sheet_id", "axis", "pos", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("island")


@query("gr12_components", """, e as (select distinct sheet_id, a_id as a, b_id as b from pairs where abs(ax1-bx1) <= 900), n as (select sheet_id, a as n from e union select sheet_id, b from e), both_ as (select sheet_id, a, b from e union select sheet_id, b, a from e),
reach(sheet_id, n, m) as (select sheet_id, n, n from n union select r.sheet_id, b.b, r.m from reach r join both_ b on r.sheet_id=b.sheet_id and r.n=b.a where r.m < b.b)
select sheet_id, n as node, min(m) as component from reach group by sheet_id, n""")
def gr12(spark, sf):
    e = d.pairs(spark, sf).where("abs(ax1 - bx1) <= 900")
    node = lambda c: F.struct("sheet_id", F.col(c).alias("n"))
    return connected_components(e.select(node("a_id").alias("a"), node("b_id").alias("b"))).select("node.sheet_id", F.col("node.n").alias("node"), F.col("component.n").alias("component"))


def merged_points(spark, sf):
    """points and entries of every sheet, after stitching, outlines and merging."""
    runs = x.drop_outlines(stash(stitched(spark, sf), "stitched"), d.symbols(spark, sf), KEY, 3.0)
    return x.merged_points_of(stash(runs, "runs"), d.symbols(spark, sf))


@query("g08_merged_points")
def g08(spark, sf):
    return merged_points(spark, sf)[0].select("sheet_id", "point_id", "kind", F.round("x", 1).alias("x"), F.round("y", 1).alias("y"), "symbols")


@query("gr13_symbol_links")
def gr13(spark, sf):
    points, entries = merged_points(spark, sf)
    return x.symbol_links(points, x.chain(entries))


@query("gr14_pruned_runs")
def gr14(spark, sf):
    return x.prune(stitched(spark, sf), d.symbols(spark, sf)).select("sheet_id", "axis", "run_id")


@query("j19_gap_crossings", """select g.sheet_id, g.line_ix, count(v.line_ix) as crossings from (select sheet_id, line_ix, pos, hi as lo, hi+200 as hi from segments where axis='h') g left join segments v on g.sheet_id=v.sheet_id and v.axis='v' and v.pos>g.lo and v.pos<g.hi and g.pos between v.lo and v.hi group by g.sheet_id, g.line_ix""")
def j19(spark, sf):
    s = d.segments(spark, sf)
    gaps = s.where("axis = 'h'").select("sheet_id", F.col("line_ix").alias("gap_id"), F.col("pos").alias("level"), F.col("hi").alias("lo"), (F.col("hi") + 200).alias("hi"))
    return ln.crossing_counts(gaps, s.where("axis = 'v'"), KEY).select("sheet_id", F.col("gap_id").alias("line_ix"), "crossings")


@query("gr16_grown_component")
def gr16_grown(spark, sf):
    runs = stash(stitched(spark, sf), "stitched")
    _, entries = x.points_of(runs, d.symbols(spark, sf))
    return x.grown(runs, entries, 0.2)
