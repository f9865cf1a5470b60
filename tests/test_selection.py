"""Scans, merged points, grown parts and raster stages against plain Python."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetgraph.operators import crossing as x
from sheetgraph.operators import greedy as gd
from sheetgraph.operators import lines as ln
from sheetgraph.operators import raster as ra
from sheetgraph.plans import connect, images, job
from sheetgraph.sources import images as im


def _kept(lines):
    """The scan over (line_ix, x1, y1, x2, y2), longest first."""
    kept = []
    for c in sorted(lines, key=lambda s: (-math.hypot(s[3] - s[1], s[4] - s[2]), s[0])):
        cn = math.hypot(c[3] - c[1], c[4] - c[2])
        for k in kept:
            kn = math.hypot(k[3] - k[1], k[4] - k[2])
            ux, uy = ((k[3] - k[1]) / kn, (k[4] - k[2]) / kn) if kn else (0.0, 0.0)
            turn = abs(math.degrees(math.atan2(c[4] - c[2], c[3] - c[1])) % 180 - math.degrees(math.atan2(k[4] - k[2], k[3] - k[1])) % 180)
            ends = [(c[1] - k[1], c[2] - k[2]), (c[3] - k[1], c[4] - k[2])]
            off, on = [abs(a * uy - b * ux) for a, b in ends], [a * ux + b * uy for a, b in ends]
            if min(turn, 180 - turn) <= 10 and max(off) <= 5 and cn > 0 and (min(kn, max(on)) - max(0, min(on))) / cn >= 0.25:
                break
        else:
            kept.append(c)
    return {c[0] for c in kept}


def test_one_segment_a_stroke(spark):
    rng = np.random.default_rng(1)
    lines = []
    for k in range(160):
        a, n = rng.uniform(0, math.pi), rng.uniform(5, 200)
        p = rng.uniform(0, 300, 2)
        for j in range(int(rng.integers(1, 4))):  # the same stroke, shifted, shortened and turned a little
            b, m, q = a + rng.normal(0, 0.05), n * rng.uniform(0.2, 1.2), p + rng.normal(0, 2.5, 2)
            lines.append((10 * k + j, *map(float, q), float(q[0] + m * math.cos(b)), float(q[1] + m * math.sin(b))))
    lines += [(9000, 5.0, 5.0, 5.0, 5.0), (9001, 5.0, 5.0, 5.0, 5.0)]
    df = spark.createDataFrame([(1, *s) for s in lines], "sheet_id long, line_ix long, x1 double, y1 double, x2 double, y2 double")
    got = {r.line_ix for r in ln.deduplicated(df, ["sheet_id"]).collect()}
    assert got == _kept(lines) and len(got) < len(lines) - 40


def test_a_long_staircase_settles(spark):
    items = spark.createDataFrame([(1, k) for k in range(420)], "sheet_id long, i long")
    pairs = spark.createDataFrame([(1, k, k + 1) for k in range(419)], "sheet_id long, one long, other long")
    assert sorted(r.i for r in gd.keep_best(items, pairs.where("one < 30"), ["sheet_id"], "i", ["i"]).collect()) == sorted([*range(0, 31, 2), *range(31, 420)])


def test_absorber_stands_for_the_contact(spark):
    """A junction takes in a symbol's entry; the exit on the same run then stays apart, one on another run does not."""
    points = spark.createDataFrame([(1, 0, "junction", 10.0, 10.0, []), (1, 1, "symbol", 11.0, 10.0, [7]), (1, 2, "symbol", 12.0, 10.0, [7]), (1, 3, "symbol", 10.0, 11.0, [8])], x.POINT)
    entries = spark.createDataFrame([(1, "h", 5, 10.0, 0), (1, "v", 6, 10.0, 0), (1, "h", 5, 11.0, 1), (1, "h", 5, 12.0, 2), (1, "v", 6, 11.0, 3)], x.ENTRY)
    merged, held = x.merge_points(points, entries, 3.0)
    assert {(r.point_id, r.kind, tuple(r.symbols)) for r in merged.collect()} == {(0, "symbol", (7, 8)), (2, "symbol", (7,))}
    assert Counter(r.point_id for r in held.collect()) == {0: 4, 2: 1}


def test_grown_part(spark):
    runs = spark.createDataFrame([(1, "h", k, 0.0, float(100 - k)) for k in range(6)] + [(1, "v", 9, 0.0, 500.0)], "sheet_id long, axis string, run_id long, lo double, hi double")
    entries = spark.createDataFrame([(1, "h", a, 0.0, p) for p, (a, b) in enumerate([(0, 1), (1, 2), (0, 3), (3, 4)]) for a in (a, b)], x.ENTRY)
    pick = lambda f: {(r.axis, r.run_id) for r in x.grown(runs, entries, f).collect()}
    assert pick(0.5) == {("h", 0), ("h", 1), ("h", 3)} and pick(1.0) == {("h", k) for k in range(5)}


def test_thinning_in_half_steps_and_of_thick_strokes():
    m = np.zeros((20, 40), bool)
    m[4:9, 2:38] = True
    m[14, 2:38] = True
    half, one, whole, thick = ra.thinned(m, 0.5), ra.thinned(m, 1), ra.thinned(m), ra.thinned(m, thick=4)
    assert m.sum() > half.sum() > one.sum() > whole.sum()
    assert (thick[12:] == m[12:]).all() and (thick[:12] == whole[:12]).all()
    assert ra.depth(m)[6, 20] == 3 and ra.depth(m)[14, 20] == 1 and ra.depth(m)[0, 0] == 0
    brute = lambda y, x_: min(math.hypot(y - a, x_ - b) for a, b in zip(*np.nonzero(~m), strict=True))
    assert all(abs(ra.depth(m)[y, x_] - brute(y, x_)) < 1e-9 for y, x_ in zip(*np.nonzero(m), strict=True))
    assert 2 < ra.stroke_width(m) < 4


def test_red_by_hue_and_by_lead():
    rgb = np.array([[[200, 10, 10], [255, 0, 128], [255, 160, 60], [10, 200, 10], [60, 20, 25], [128, 128, 128], [20, 20, 200]]], np.uint8)
    assert ra.red(rgb)[0].tolist() == [True, True, True, False, True, False, False]


def test_strokes_are_found(spark):
    rgb = np.full((60, 80, 3), 255, np.uint8)
    rgb[10, 5:70] = 0
    rgb[5:55, 40] = 0
    rgb[np.arange(20, 50), np.arange(45, 75)] = 0
    df = spark.createDataFrame([(1, 60, 80, bytearray(rgb.tobytes()), [[0, 0, 3, 3]])], im.IMAGE + ", boxes array<array<int>>")
    got = {tuple(sorted([(round(r.x1), round(r.y1)), (round(r.x2), round(r.y2))])) for r in ra.detect_lines(least=12)(df).collect()}
    for a, b in (((5, 10), (69, 10)), ((40, 5), (40, 54)), ((45, 20), (74, 49))):
        assert any(math.dist(a, p) <= 2 and math.dist(b, q) <= 2 for p, q in got), (a, b, got)
    assert len(got) <= 6


def test_line_types_and_corners_from_ink(spark):
    rgb = np.full((60, 200, 3), 255, np.uint8)
    for k in range(10, 150, 10):
        rgb[20, k : k + 6] = 0  # dashes of 6 with gaps of 4
    rgb[40, 10:150] = 0
    rgb[30:41, 160] = 0
    pic = spark.createDataFrame([(1, 60, 200, bytearray(rgb.tobytes()))], im.IMAGE)
    rows = [(1, k, "h", 20, 10 * k + 10, 10 * k + 16) for k in range(14)] + [(1, 20, "h", 40, 10, 150), (1, 21, None, 0, 0, 0)]
    s = spark.createDataFrame(rows, "sheet_id long, line_ix long, axis string, at long, lo long, hi long")
    got = {r.line_ix: (r.dashed, r.dash, r.gap) for r in images.classified(s, pic, 3916).collect()}
    assert all(got[k] == (True, 6.0, 4.0) for k in range(14)) and not got[20][0] and not got[21][0]
    spans = spark.createDataFrame([(1, 1, "h", 41, 0, 100), (1, 2, "h", 52, 0, 100), (1, 3, "v", 160, 30, 41), (1, 4, "h", 50, 9, 9)], "sheet_id long, span_id long, axis string, level long, lo long, hi long")
    assert {r.span_id: r.evidence for r in ra.evidence(pic, spans, band=5, share=0.5).collect()} == {1: True, 2: False, 3: True, 4: True}
    runs = spark.createDataFrame([(1, "h", 40, 10, 150), (1, "v", 160, 10, 30)], "sheet_id long, axis string, level long, lo long, hi long")
    assert {(r.axis, r.level, r.lo, r.hi) for r in images.corner_stubs(runs, 15.0).collect()} == {("h", 40, 150, 160), ("v", 160, 30, 40)}


def test_images_are_read(spark, tmp_path):
    rgb = np.random.default_rng(2).integers(0, 256, (7, 9, 3), dtype=np.uint8)
    (tmp_path / "a.png").write_bytes(im.png(rgb))
    r = im.read_images(spark, str(tmp_path)).first()
    assert (r.height, r.width) == (7, 9) and bytes(r.pixels) == rgb.tobytes()


def test_a_job_stores_what_it_counts(spark, tmp_path):
    from sheetgraph.sources import derived as d

    sf = "/root/testdata/sf0.001"
    s = d.segments(spark, sf).where("sheet_id = 0").withColumn("dashed", F.col("line_type") == "dashed")
    own = lambda df: df.where("sheet_id = 0")
    graph = job.crossing_graph(s, own(d.symbols(spark, sf)), own(d.texts(spark, sf)))
    r = job.run_sheets(s, own(d.symbols(spark, sf)), own(d.texts(spark, sf)), f"file://{tmp_path}/out").collect()
    assert len(r) == 1 and {k: r[0][k] for k in graph} == {k: v.count() for k, v in graph.items()}


def test_no_join_on_the_sheet_alone(spark):
    from sheetgraph.plans.all import QUERIES

    for name in ("j13_nearest_symbol", "j14_nearest_lines", "l07_crops", "j03_line_line", "g01_kept_segments"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


@pytest.mark.parametrize("name", ["symbol", "text"])
def test_tiles_keep_the_best_of_a_place(spark, name):
    """The scan over both kinds of boxes, in plain Python."""
    s, t = connect.of_tiles(spark, "/root/testdata/sf0.001")
    rows = [r for r in (s if name == "symbol" else t).collect() if r.sheet_id == 0]
    area = lambda b: (b.x2 - b.x1) * (b.y2 - b.y1)
    both = lambda a, b: max(0, min(a.x2, b.x2) - max(a.x1, b.x1)) * max(0, min(a.y2, b.y2) - max(a.y1, b.y1))
    near = (lambda a, b: both(a, b) / min(area(a), area(b)) > 0.5) if name == "symbol" else (lambda a, b: both(a, b) / (area(a) + area(b) - both(a, b)) > 0.4)
    kept = []
    for r in sorted(rows, key=lambda r: (-(r.score or 0.5), r.item_id)):
        if not any(near(r, k) for k in kept):
            kept.append(r)
    got = {r.item_id for r in connect.g05(spark, "/root/testdata/sf0.001").where(f"sheet_id = 0 and kind = '{name}'").collect()}
    assert got == {k.item_id for k in kept}


def test_scratch_removes_its_tables(spark, tmp_path):
    from sheetgraph.plans import stages

    kept = stages.stash(spark.range(3).toDF("a"), "kept")
    with stages.scratch():
        s = stages.stash(spark.range(5).toDF("a"), "gone")
        s.write.parquet(f"file://{tmp_path}/out")
    assert kept.count() == 3 and not stages.exists(spark, s._stash_path) and spark.read.parquet(f"file://{tmp_path}/out").count() == 5
    stages.drop_stash(kept)
    assert not stages.exists(spark, kept._stash_path)


def test_published_sources_of_carried_ones(spark):
    """The pass over what propagation really carries, against the rule on sets."""
    from sheetgraph.operators import graph as gr

    temp, *_ = connect.propagated(spark, "/root/testdata/sf0.001")
    rows = {(r.sheet_id, r.node, r.source) for r in temp.collect()}
    of = {}
    for sheet, node, source in rows:
        of.setdefault((sheet, node), set()).add(source)
    keeps = {k for k, own in of.items() if any(k[1] not in of.get((k[0], x), ()) for x in own)}
    got = {(r.sheet_id, r.node, r.source) for r in gr.published_sources(temp).collect()}
    assert rows and got == {r for r in rows if r[:2] in keeps}


def test_runs_without_two_entries_go_in_turn(spark):
    run = lambda axis, k, pos, lo, hi: (1, axis, k, float(pos), float(lo), float(hi))
    rows = [run("h", 1, 100, 0, 400), run("h", 2, 300, 0, 400), run("v", 3, 50, 0, 400), run("v", 4, 350, 0, 400), run("v", 5, 200, 90, 220), run("h", 6, 200, 190, 330), run("v", 7, 320, 190, 260)]
    df = spark.createDataFrame(rows, "sheet_id long, axis string, run_id long, pos double, lo double, hi double")
    none = spark.createDataFrame([], "sheet_id long, symbol_id long, x1 double, y1 double, x2 double, y2 double")
    assert {r.run_id for r in x.prune(df, none).collect()} == {1, 2, 3, 4, 5, 6} - {5, 6}  # 7 meets one run, then 6, then 5


def test_gaps_are_bridged_where_there_is_ink(spark):
    rgb = np.full((300, 400, 3), 255, np.uint8)
    rgb[50, 10:300] = 0  # one stroke under two pieces
    rgb[150, 10:60] = 0
    rgb[150, 200:300] = 0  # two strokes with nothing between
    pic = spark.createDataFrame([(1, 300, 400, bytearray(rgb.tobytes()))], im.IMAGE)
    rows = [(1, k, a, y, b, y) for k, (y, a, b) in enumerate([(500.0, 100.0, 900.0), (500.0, 1300.0, 2900.0), (1500.0, 100.0, 550.0), (1500.0, 2100.0, 2900.0), (2500.0, 5.0, 12.0)])]
    lines = spark.createDataFrame([*rows, (1, 9, 10.0, 10.0, 500.0, 500.0)], "sheet_id long, line_ix long, x1 double, y1 double, x2 double, y2 double")
    got = {(r.axis, r.level, r.lo, r.hi) for r in images.chained(lines, pic, 10).collect()}
    assert got == {("h", 500, 100, 2900), ("h", 1500, 100, 550), ("h", 1500, 2100, 2900)}


def test_arrows_point_where_their_line_leads(spark):
    from sheetgraph.functions import text as t
    from sheetgraph.operators import graph as gr

    box = lambda k, cx, cy: (1, k, t.ARROW, cx - 0.01, cy - 0.01, cx + 0.01, cy + 0.01)
    s = spark.createDataFrame([box(1, 0.5, 0.5), box(2, 0.5, 0.8), box(3, 0.2, 0.2)], "sheet_id long, symbol_id long, label string, x1 double, y1 double, x2 double, y2 double")
    line = lambda k, a, b, c, d, e: (1, k, a, b, c, d, *e)
    lines = [line(1, 0.3, 0.5, 0.489, 0.5, (0.1, 0.5, 0.689, 0.5)), line(2, 0.5, 0.6, 0.5, 0.789, (0.5, 0.4, 0.5, 0.989)), line(3, 0.1, 0.2, 0.189, 0.2, (0.0, 0.2, 0.389, 0.2)), line(4, 0.2, 0.211, 0.2, 0.3, (0.2, 0.011, 0.2, 0.5))]
    l = spark.createDataFrame(lines, "sheet_id long, line_ix long, x1 double, y1 double, x2 double, y2 double, ex1 double, ey1 double, ex2 double, ey2 double")
    edges = spark.createDataFrame([(1, "l-1", "s-1", 0), (1, "l-2", "s-2", 1), (1, "l-3", "s-3", 2), (1, "l-4", "s-3", 3)], "sheet_id long, a string, b string, ord long")
    got = {r.symbol_id: (r.source, r.direction) for r in gr.arrow_directions(edges, s, l).collect()}
    assert got == {1: ("l-1", "right"), 2: ("l-2", "down"), 3: (None, "unknown")}
