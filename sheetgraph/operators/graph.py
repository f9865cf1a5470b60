"""The property graph of a sheet and traversals that respect its order."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetgraph.functions import text as t
from sheetgraph.operators.spatial import moved

KEY = ["sheet_id"]


def edges_of(candidates: DataFrame) -> DataFrame:
    """(a, b, ord): one row per candidate, in order of line and side, from the line to what it connects to."""
    prefix = F.when(F.col("type") == "symbol", F.lit("s-")).when(F.col("type") == "text", F.lit("l-t-")).otherwise(F.lit("l-"))
    order = F.row_number().over(Window.partitionBy(*KEY).orderBy("line_ix", F.desc("side")))  # start before end
    return candidates.select(*KEY, t.node_id("l", F.col("line_ix")).alias("a"), F.concat(prefix, F.col("node").cast("string")).alias("b"), (order - 1).alias("ord"))


def text_lines(candidates: DataFrame) -> DataFrame:
    """(text_ix, line_ix): the first line that names each text stands for it."""
    return candidates.where("type = 'text'").groupBy(*KEY, F.col("node").alias("text_ix")).agg(F.min("line_ix").alias("line_ix"))


def both_ways(edges: DataFrame) -> DataFrame:
    """(a, b, ord) in both directions; parallel edges once, at their first place; loops once."""
    way = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    ways = F.when(F.col("a") != F.col("b"), F.array(way("a", "b"), way("b", "a"))).otherwise(F.array(way("a", "b")))
    two = moved(edges, KEY).select(*KEY, "ord", F.inline(ways)).select(*KEY, "a", "b", "ord")
    return two.groupBy(*KEY, "a", "b").agg(F.min("ord").alias("ord"))


def degrees(edges: DataFrame) -> DataFrame:
    return both_ways(edges).groupBy(*KEY, F.col("a").alias("node")).agg((F.count("*") + F.count_if(F.col("a") == F.col("b"))).alias("degree"))


def junction_arrows(edges: DataFrame, symbols: DataFrame, arrow: str = t.ARROW) -> DataFrame:
    """Arrows with more than two neighbours, more than two of them lines."""
    arrows = symbols.where(F.col("label") == arrow).select(*KEY, t.node_id("s", F.col("symbol_id")).alias("a"))
    n = both_ways(edges).join(arrows, [*KEY, "a"]).groupBy(*KEY, F.col("a").alias("node")).agg(F.count("*").alias("degree"), F.count_if(F.col("b").startswith("l-")).alias("lines"))
    return n.where("degree > 2 and lines > 2")


def assets(symbols: DataFrame, every: bool = True, arrows: bool = True, flow: tuple[str, ...] = ("Equipment/", "Piping/Endpoint/Pagination"), valve: str = "Instrument/Valve/", with_text: tuple[str, ...] = ("Equipment/", "Instrument/", "Piping/Endpoint/Pagination")) -> DataFrame:
    """symbols with is_asset, is_valve and is_flow: of all symbols, or of those with a proper tag."""
    label, text = F.col("label"), F.col("text_associated")
    counted = (label != t.ARROW) | F.lit(every and arrows)
    if every:
        tagged = proper = F.lit(True)
    else:
        tagged = text.isNotNull()
        proper = tagged & t.has_letter_and_digit(text) & ~t.is_size(text) & t.starts_with_any(label, with_text, True)
    yes = lambda c: F.coalesce(counted & c, F.lit(False))
    return symbols.withColumns({"is_asset": yes(proper), "is_valve": yes(proper & t.starts_with_any(label, (valve,), True)), "is_flow": yes(tagged & t.starts_with_any(label, flow, True))})


WALK = "sheet_id long, start string, node string, flow string, "


def _listed(edges: DataFrame, starts: DataFrame, stops: DataFrame, sources: DataFrame, junctions: DataFrame | None = None) -> DataFrame:
    """(kind, a, b, ord): all that a sheet's walks need, in one table."""
    kind = lambda n, df, a, b=None: df.select(*KEY, F.lit(n).alias("kind"), F.col(a).alias("a"), (F.col(b) if b else F.lit(None).cast("string")).alias("b"), (F.col("ord").cast("long") if n == "edge" else F.lit(0).cast("long")).alias("ord"))
    every = kind("edge", both_ways(edges), "a", "b").unionByName(kind("start", starts, "node")).unionByName(kind("stop", stops, "node")).unionByName(kind("source", sources, "node", "source"))
    return every if junctions is None else every.unionByName(kind("junction", junctions, "node"))


def _walks(pdf: pd.DataFrame, propagate: bool = False, exhaustive: bool = False, most_paths: int = 100_000, paths: bool = True) -> Iterator[tuple[str, list[tuple]]]:
    """Each start of a sheet and its walks (node, flow, path), or their number of steps for the path."""
    of = {k: v for k, v in pdf.groupby("kind")}
    near: dict[str, list[str]] = {}
    if "edge" in of:
        e = of["edge"].sort_values(["ord", "a", "b"], kind="stable")
        for a, b in zip(e["a"], e["b"], strict=True):
            near.setdefault(a, []).append(b)
    feeds: dict[str, set[str]] = {}
    if "source" in of:
        for a, b in zip(of["source"]["a"], of["source"]["b"], strict=True):
            feeds.setdefault(a, set()).add(b)
    stop, junction = (set(of[k]["a"]) if k in of else set() for k in ("stop", "junction"))
    for start in sorted(set(of["start"]["a"])) if "start" in of else ():
        out, seen, queue, at = [], {start}, [(start, "unknown", () if paths else 0)], 0
        while at < len(queue):
            here, flow, path = queue[at]
            at += 1
            for nxt in near.get(here, ()):
                if nxt == start or (nxt in path if exhaustive else nxt in seen):
                    continue
                seen.add(nxt)
                if nxt in feeds.get(here, ()):
                    continue
                down = here in feeds.get(nxt, ())
                now = "downstream" if down else flow
                if (propagate and down and nxt in junction) or nxt in stop:
                    out.append((nxt, now, path))
                    continue
                queue.append((nxt, now, (*path, nxt) if paths else path + 1))
            if len(queue) + len(out) > most_paths:
                raise RuntimeError(f"{start} has over {most_paths} paths")
        yield start, out


def traverse(edges: DataFrame, starts: DataFrame, stops: DataFrame, sources: DataFrame, junctions: DataFrame | None = None, exhaustive: bool = False, most_paths: int = 100_000, paths: bool = True) -> DataFrame:
    """(start, node, flow, path): what each start reaches, breadth first, ending at stops.

    edges(a, b, ord) are walked in order of ord. sources(node, source) mark flow: a step to a
    source of where one stands goes up and is not taken (though the node counts as visited);
    a step from a source goes down, and the walk stays "downstream". With junctions (a
    propagation pass), an arrow there that is reached downstream ends the walk. Exhaustive
    walks follow every simple path; a start with over most_paths of them is an error, not a
    silent cut. Without paths, `steps` counts the nodes between (walks that aren't exhaustive only).
    """
    if exhaustive and not paths:
        raise ValueError("exhaustive walks need their paths")
    propagate = junctions is not None

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [(start, node, flow, list(path) if paths else path) for start, walks in _walks(pdf, propagate, exhaustive, most_paths, paths) for node, flow, path in walks]
        got = pd.DataFrame(out, columns=["start", "node", "flow", "path" if paths else "steps"])
        got.insert(0, "sheet_id", pdf["sheet_id"].iloc[0])
        return got

    return _listed(edges, starts, stops, sources, junctions).groupBy(*KEY).applyInPandas(run, WALK + ("path array<string>" if paths else "steps int"))


def carried_sources(walks: DataFrame) -> DataFrame:
    """(node, source) that downstream walks add: each node on the path, and the end, from the one before it."""
    chain = F.concat(F.array("start"), F.col("path"), F.array("node"))
    steps = walks.where("flow = 'downstream'").select(*KEY, chain.alias("c"))
    pairs = F.transform(F.sequence(F.lit(2), F.size("c")), lambda k: F.struct(F.element_at("c", k).alias("node"), F.element_at("c", k - 1).alias("source")))
    return steps.select(*KEY, F.explode(pairs).alias("p")).select(*KEY, "p.*").distinct()


def published_sources(temp: DataFrame) -> DataFrame:
    """temp(node, source) of nodes that some source does not itself take as a source; others are circular and lose theirs."""
    back = temp.select(*KEY, F.col("node").alias("source"), F.col("source").alias("node"), F.lit(True).alias("_back"))
    traced = temp.join(back, [*KEY, "node", "source"], "left").where("_back is null").select(*KEY, "node").distinct()
    return temp.join(traced, [*KEY, "node"], "left_semi")


def connections(edges: DataFrame, starts: DataFrame, stops: DataFrame, sources: DataFrame, symbols: DataFrame, boxes: DataFrame) -> DataFrame:
    """One row per asset with its connections (walk, id, label, text, flow, segments), nested for a JSON sink.

    A flow is told only between flow assets and valves. boxes(node, x1, y1, x2, y2) place path nodes. The walks of a
    sheet are placed and nested where they are made: a path has many more nodes than its sheet, so paths never move.
    """
    s = symbols.select(*KEY, t.node_id("s", F.col("symbol_id")).alias("node"), "symbol_id", "label", t.display_name(F.col("text_associated"), F.col("label"), F.col("symbol_id")).alias("text"), (F.col("is_flow") | F.col("is_valve")).alias("process"))
    place, about = F.struct(*[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]), F.struct(F.col("symbol_id").alias("id"), "label", "text", "process")
    more = boxes.select(*KEY, F.lit("box").alias("kind"), F.col("node").alias("a"), place.alias("box")).unionByName(s.select(*KEY, F.lit("symbol").alias("kind"), F.col("node").alias("a"), about.alias("about")), allowMissingColumns=True)
    every = _listed(edges, starts, stops, sources).unionByName(more, allowMissingColumns=True)
    key, kinds = T.StructField("sheet_id", T.LongType()), {f.name: f.dataType for f in s.schema}
    ends = [T.StructField("id", kinds["symbol_id"]), T.StructField("label", kinds["label"]), T.StructField("text", kinds["text"])]
    segment = T.StructType([T.StructField(c, T.DoubleType()) for c in ("x1", "y1", "x2", "y2")])
    item = T.StructType([T.StructField("walk", T.IntegerType()), *ends, T.StructField("flow", T.StringType()), T.StructField("segments", T.ArrayType(segment))])
    schema = T.StructType([key, T.StructField("node", T.StringType()), T.StructField("connections", T.ArrayType(item)), T.StructField("symbol_id", kinds["symbol_id"]), *ends[1:]])

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["kind", "a", "b", "ord"]).to_pandas()
        number = {k: v.index.to_numpy() for k, v in rows.groupby("kind")}
        names, box, about = rows["a"].to_numpy(), table["box"].combine_chunks(), table["about"].combine_chunks()
        process = about.field("process").to_pylist()
        placed, told = {}, {}
        for k in number.get("box", ()):
            placed.setdefault(names[k], []).append(k)
        for k in number.get("symbol", ()):
            told.setdefault(names[k], []).append(k)
        at, size, of, walk, flows, spans, bits = [], [], [], [], [], [0], []
        for start, walks in _walks(rows):
            mine = [(n + 1, flow, path, k) for n, (node, flow, path) in enumerate(sorted(walks)) for k in told.get(node, ())]
            for here in told.get(start, ()) if mine else ():
                at.append(here)
                size.append(len(mine))
                for n, flow, path, k in mine:
                    of.append(k)
                    walk.append(n)
                    flows.append(flow if process[here] and process[k] else "unknown")
                    bits.extend(b for node in path for b in placed.get(node, ()))
                    spans.append(len(bits))
        whole = lambda v, kind=pa.int64(): pa.array(v, kind)
        told_of = lambda name, k: about.field(name).take(whole(k))
        segments = pa.ListArray.from_arrays(whole(spans, pa.int32()), box.take(whole(bits)))
        items = pa.StructArray.from_arrays([whole(walk, pa.int32()), *[told_of(n, of) for n in ("id", "label", "text")], pa.array(flows, pa.string()), segments], ["walk", "id", "label", "text", "flow", "segments"])
        nested = pa.ListArray.from_arrays(whole([0, *itertools.accumulate(size)], pa.int32()), items)
        sheet = table["sheet_id"].combine_chunks().take(whole([0] * len(at)))
        return pa.table([sheet, pa.array([names[k] for k in at], pa.string()), nested, *[told_of(n, at) for n in ("id", "label", "text")]], names=schema.names)

    return every.groupBy(*KEY).applyInArrow(run, schema)


def arrow_directions(edges: DataFrame, symbols: DataFrame, lines: DataFrame, share: float = 0.5) -> DataFrame:
    """(symbol_id, source, direction): the side of an arrow's box that its one centred line comes in by.

    lines(line_ix, x1..y2, ex1..ey2) also hold their extension. The line enters the box where
    its extension first meets it on the side nearer to its own ends; none or several such hits
    leave the direction unknown.
    """
    arrows = symbols.where(F.col("label") == t.ARROW).select(*KEY, "symbol_id", t.node_id("s", F.col("symbol_id")).alias("a"), *[F.col(c).cast("double").alias(f"_q{c}") for c in ("x1", "y1", "x2", "y2")])
    near = both_ways(edges).where(F.col("b").rlike("^l-[0-9]+$")).select(*KEY, "a", t.node_key(F.col("b")).alias("line_ix"))
    m = arrows.join(near, [*KEY, "a"]).join(lines, [*KEY, "line_ix"])
    dx, dy = F.col("ex2") - F.col("ex1"), F.col("ey2") - F.col("ey1")
    lo, hi = [], []
    missed = F.lit(False)
    for p, d_, a, b in (("ex1", dx, "_qx1", "_qx2"), ("ey1", dy, "_qy1", "_qy2")):
        t1, t2 = F.try_divide(F.col(a) - F.col(p), d_), F.try_divide(F.col(b) - F.col(p), d_)
        missed = missed | ((d_ == 0) & ((F.col(p) < F.col(a)) | (F.col(p) > F.col(b))))
        lo.append(F.coalesce(F.least(t1, t2), F.lit(0.0)))
        hi.append(F.coalesce(F.greatest(t1, t2), F.lit(1.0)))
    m = m.withColumns({"_t1": F.greatest(F.lit(0.0), *lo), "_t2": F.least(F.lit(1.0), *hi)}).where(~missed & (F.col("_t1") < F.col("_t2")))
    at = lambda c, t_: F.col(f"e{c}1") + F.col(t_) * (dx if c == "x" else dy)
    far = lambda t_: F.least(F.hypot(at("x", t_) - F.col("x1"), at("y", t_) - F.col("y1")), F.hypot(at("x", t_) - F.col("x2"), at("y", t_) - F.col("y2")))
    m = m.withColumn("_t", F.when(far("_t1") < far("_t2"), F.col("_t1")).otherwise(F.col("_t2"))).withColumns({"_x": at("x", "_t"), "_y": at("y", "_t")})
    w, h = F.col("_qx2") - F.col("_qx1"), F.col("_qy2") - F.col("_qy1")
    off_x, off_y = F.abs(F.col("_x") - (F.col("_qx1") + F.col("_qx2")) / 2) / (w / 2), F.abs(F.col("_y") - (F.col("_qy1") + F.col("_qy2")) / 2) / (h / 2)
    same = lambda c, q: F.abs(F.col(c) - F.col(q)) < 1e-9
    sides = [(same("_y", "_qy1") & (off_x < share), "down"), (same("_x", "_qx2") & (off_y < share), "left"), (same("_y", "_qy2") & (off_x < share), "up"), (same("_x", "_qx1") & (off_y < share), "right")]
    hits = m.select(*KEY, "symbol_id", "line_ix", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in sides]))).alias("direction"))
    one = hits.groupBy(*KEY, "symbol_id").agg(F.count("*").alias("n"), F.min(F.struct("line_ix", "direction")).alias("h"))
    sure = F.col("n") == 1
    return arrows.select(*KEY, "symbol_id").join(one, [*KEY, "symbol_id"], "left").select(*KEY, "symbol_id", F.when(sure, t.node_id("l", F.col("h.line_ix"))).alias("source"), F.coalesce(F.when(sure, F.col("h.direction")), F.lit("unknown")).alias("direction"))


def reach_within(edges: DataFrame, contacts: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """(point_id, depth): points within `hops` symbols of the seeds; a step onto a point with a symbol costs one, others none.

    edges(a, b) join points, contacts(point_id) hold symbols, seeds(point_id) start. Each round
    relaxes all edges once, until no depth falls.
    """
    from sheetgraph.plans.stages import drop_stash, stash

    two = edges.select(*KEY, "a", "b").union(edges.select(*KEY, F.col("b"), F.col("a"))).distinct()
    costed = stash(two.join(contacts.select(*KEY, F.col("point_id").alias("b"), F.lit(1).alias("cost")).distinct(), [*KEY, "b"], "left").select(*KEY, "a", "b", F.coalesce("cost", F.lit(0)).alias("cost")), "costs")
    depth = stash(seeds.select(*KEY, "point_id", F.lit(0).alias("depth")).distinct(), "depth")
    before = None
    while True:
        now = depth.agg(F.count("*"), F.sum("depth")).first()
        if now == before:
            return depth
        before = now
        step = depth.join(costed.withColumnRenamed("a", "point_id"), [*KEY, "point_id"]).select(*KEY, F.col("b").alias("point_id"), (F.col("depth") + F.col("cost")).alias("depth")).where(F.col("depth") <= hops)
        nxt = stash(depth.union(step).groupBy(*KEY, "point_id").agg(F.min("depth").alias("depth")), "depth")
        drop_stash(depth)
        depth = nxt
