"""Operators against plain Python on random sheets."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetgraph.operators import candidates as c
from sheetgraph.operators import crossing as x
from sheetgraph.operators import graph as gr
from sheetgraph.operators import greedy as gd
from sheetgraph.operators import lines as ln
from sheetgraph.operators.components import connected_components


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)] + [(7, 7), (None, 3)]
    parent = {n: n for e in edges for n in e if None not in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        if a is not None and find(a) != find(b):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_fold(spark):
    rng, rows, holders = random.Random(2), [], []
    value = lambda: rng.choice([0.0, 1.0, 1.5, 2.0, 5.0, 20.0, 49.0, 50.0, 60.0])
    for line in range(80):
        for side in ("start", "end"):
            if rng.random() < 0.5:
                holders.append((1, line, side, rng.randrange(99), rng.choice(["symbol", "text"]), value(), False))
        for target in rng.sample(range(500), rng.randrange(0, 7)):
            sl, el = value(), value()
            rows.append((1, line, target, sl + rng.choice([0.0, 3.0]), el + rng.choice([0.0, 3.0]), sl, el))
    empty = {"node": None, "type": "unknown", "distance": None, "intersection": False}
    expected = {}
    for line in range(80):
        slot = {s: dict(empty) for s in ("start", "end")}
        for h in holders:
            if h[1] == line:
                slot[h[2]] = dict(zip(("node", "type", "distance", "intersection"), h[3:], strict=True))
        for _, _, target, sp, ep, sl, el in sorted(r for r in rows if r[1] == line):
            def may(side, d, body):
                s = slot[side]
                box = s["type"] in ("symbol", "text")
                if box and s["distance"] <= 2:
                    return False
                if s["distance"] is None:
                    return True
                if body:
                    return (s["intersection"] or box) and d < s["distance"]
                return s["intersection"] or d < s["distance"]

            new = lambda d, body: {"node": target, "type": "line", "distance": d, "intersection": body}
            if sp <= ep and sp < 50 and may("start", sp, False):
                slot["start"] = new(sp, False)
            elif ep < sp and ep < 50 and may("end", ep, False):
                slot["end"] = new(ep, False)
            elif sl <= el and sl < 50 and may("start", sl, True):
                slot["start"] = new(sl, True)
            elif el < sl and el < 50 and may("end", el, True):
                slot["end"] = new(el, True)
        expected[line] = slot
    h = spark.createDataFrame(holders, "sheet_id long, line_ix long, side string, node long, type string, distance double, intersection boolean")
    t = spark.createDataFrame(rows, "sheet_id long, line_ix long, target long, sp double, ep double, sl double, el double")
    lines = spark.range(80).select(F.lit(1).cast("long").alias("sheet_id"), F.col("id").alias("line_ix"))
    got = {r.line_ix: {s: r[s].asDict() for s in ("start", "end")} for r in c.fold_lines(h, t, lines, 50.0, 2.0).collect()}
    assert got == expected


def test_greedy_selection_and_matching(spark):
    rng = random.Random(3)
    conflicts = sorted({tuple(sorted(rng.sample(range(40), 2))) for _ in range(60)})
    kept = []
    for k in range(40):
        if not any((e, k) in conflicts for e in kept):
            kept.append(k)
    items = spark.range(40).select(F.lit(1).alias("sheet_id"), F.col("id").alias("item"))
    e = spark.createDataFrame([(1, a, b) for a, b in conflicts], "sheet_id int, earlier long, later long")
    assert sorted(r.item for r in gd.keep_greedily(items, e, ["sheet_id"], "item").collect()) == kept
    pairs = [(1, a, 100 + b, float(rng.randrange(8))) for a in range(12) for b in range(12) if rng.random() < 0.4]
    used, expected = set(), []
    for _, a, b, v in sorted(pairs, key=lambda p: (-p[3], p[1], p[2])):
        if a not in used and b not in used:
            used |= {a, b}
            expected.append((a, b))
    got = gd.match_greedily(spark.createDataFrame(pairs, "sheet_id int, l long, r long, v double"), ["sheet_id"], "l", "r", [-F.col("v")])
    assert sorted((r.l, r.r) for r in got.collect()) == sorted(expected)


@pytest.mark.parametrize("shape", [(1, 1), (3, 3), (2, 5), (5, 2), (4, 6)])
def test_hungarian(shape):
    rng = np.random.default_rng(sum(shape))
    for _ in range(20):
        m = rng.integers(-20, 20, shape).astype(float)
        r, k = gd.hungarian(m)
        small, wide = (m, m.shape) if m.shape[0] <= m.shape[1] else (m.T, m.T.shape)
        best = min(sum(small[i, p[i]] for i in range(wide[0])) for p in itertools.permutations(range(wide[1]), wide[0]))
        assert len(set(r)) == len(set(k)) == min(shape) and m[r, k].sum() == best


def test_assignment_caps_after_matching(spark):
    pairs = spark.createDataFrame([(1, 1, 10, -900.0), (1, 1, 11, -800.0), (1, 2, 10, -100.0)], "sheet_id int, s long, t long, cost double")
    got = gd.assign(pairs, ["sheet_id"], "s", "t", "cost", -500.0).collect()
    assert [(r.s, r.t, r.cost) for r in got] == [(1, 11, -800.0)]  # (2, 10) takes a partner though it is above the cap


def test_claims(spark):
    rows = [(1, 1, 7, 5.0), (1, 1, 8, 6.0), (1, 2, 7, 1.0), (1, 2, 8, 9.0), (1, 3, 7, 0.0)]
    got = gd.claim_nearest(spark.createDataFrame(rows, "sheet_id int, s long, t long, d double"), ["sheet_id"], "s", "t", "d").collect()
    assert sorted((r.s, r.t) for r in got) == [(1, 7), (2, 8)]


def test_folds(spark):
    df = spark.createDataFrame([([0.0, 4.0, 8.0, 11.0, 30.0],)], "v array<double>")
    assert df.select(ln.anchored_clusters(F.col("v"), 10.0).alias("a")).first().a == [0.0, 11.0, 30.0]
    rows = [(1, 0.0, 10.0, True, 0), (1, 12.0, 20.0, True, 0), (1, 100.0, 110.0, False, 0), (1, 105.0, 400.0, False, 9), (1, 390.0, 395.0, False, 0), (1, 500.0, 510.0, True, 3)]
    got = ln.bridged(spark.createDataFrame(rows, "k int, lo double, hi double, evidence boolean, crossings int"), ["k"]).collect()
    assert [(r.lo, r.hi, r.pieces) for r in got] == [(0.0, 20.0, 2), (100.0, 400.0, 3), (500.0, 510.0, 1)]


def test_traversal(spark):
    edges = [("s-1", "l-1"), ("l-1", "l-2"), ("l-2", "s-2"), ("l-1", "l-3"), ("l-3", "l-2"), ("l-3", "s-3"), ("s-3", "l-9")]
    e = spark.createDataFrame([(1, a, b, k) for k, (a, b) in enumerate(edges)], "sheet_id long, a string, b string, ord int")
    node = lambda *n: spark.createDataFrame([(1, x_) for x_ in n], "sheet_id long, node string")
    sources = spark.createDataFrame([(1, "l-2", "l-1"), (1, "l-3", "l-2")], "sheet_id long, node string, source string")
    walk = lambda **k: sorted((r.start, r.node, r.flow, tuple(r.path)) for r in gr.traverse(e, node("s-1"), node("s-2", "s-3"), sources, **k).collect())
    assert walk() == [("s-1", "s-2", "downstream", ("l-1", "l-2")), ("s-1", "s-3", "unknown", ("l-1", "l-3"))]
    assert ("s-1", "s-3", "downstream", ("l-1", "l-2", "l-3")) in walk(exhaustive=True)
    with pytest.raises(Exception, match="paths"):
        walk(exhaustive=True, most_paths=1)
    carried = gr.carried_sources(gr.traverse(e, node("s-1"), node("s-2", "s-3"), sources))
    assert sorted((r.node, r.source) for r in carried.collect()) == [("l-1", "s-1"), ("l-2", "l-1"), ("s-2", "l-2")]


def test_links_equal_walks(spark):
    rng = random.Random(5)
    points = [(1, k, sorted(rng.sample(range(50), rng.choice([0, 0, 1, 1, 2])))) for k in range(60)]
    edges = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(80)})
    near = {k: [b if a == k else a for a, b in edges if k in (a, b)] for k in range(60)}
    held = {k: s for _, k, s in points}
    expected = set()
    for k in range(60):
        if not held[k]:
            continue
        expected |= {tuple(sorted((a, b))) for a in held[k] for b in held[k] if a != b}
        seen, queue = {k}, list(near[k])
        while queue:
            n = queue.pop()
            if n in seen:
                continue
            seen.add(n)
            if held[n]:
                expected |= {tuple(sorted((a, b))) for a in held[k] for b in held[n] if a != b}
            else:
                queue += near[n]
    p = spark.createDataFrame([(s, k, v) for s, k, v in points], "sheet_id long, point_id long, symbols array<long>")
    e = spark.createDataFrame([(1, a, b) for a, b in edges], "sheet_id long, a long, b long")
    assert {(r.a, r.b) for r in x.symbol_links(p, e).collect()} == expected


def test_points_merge_in_order(spark):
    points = spark.createDataFrame([(1, 0, "junction", 0.0, 0.0, []), (1, 1, "symbol", 2.0, 0.0, [5]), (1, 2, "symbol", 4.0, 0.0, [5]), (1, 3, "symbol", 50.0, 0.0, [6]), (1, 4, "symbol", 52.0, 0.0, [6])], "sheet_id long, point_id long, kind string, x double, y double, symbols array<long>")
    entries = spark.createDataFrame([(1, "h", 1, 0.0, 0), (1, "h", 1, 2.0, 1), (1, "h", 2, 4.0, 2), (1, "h", 3, 50.0, 3), (1, "h", 3, 52.0, 4)], "sheet_id long, axis string, run_id long, at double, point_id long")
    merged, held = x.merge_points(points, entries, 3.0)
    assert {(r.point_id, r.kind, tuple(r.symbols)) for r in merged.collect()} == {(0, "symbol", (5,)), (2, "symbol", (5,)), (3, "symbol", (6,)), (4, "symbol", (6,))}
    assert sorted(r.point_id for r in held.collect()) == [0, 0, 2, 3, 4]
