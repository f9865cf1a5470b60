"""Lines near other lines: every pair within the threshold and none at it, for lines at any angle."""

import random

from pyspark.sql import functions as F

from sheetgraph.functions import geometry as g
from sheetgraph.operators import candidates as c

LINE = "sheet_id long, line_ix long, x1 double, y1 double, x2 double, y2 double"


def test_a_gap_of_the_threshold_is_not_near(spark):
    y = 2181 / 3000
    lines = spark.createDataFrame([(16, 364, 260 / 4000, y, 640 / 4000, y), (16, 1199, 80 / 4000, y, 210 / 4000, y), (16, 1200, 80 / 4000, y, 211 / 4000, y)], LINE)
    assert not 260 / 4000 - 210 / 4000 < 50 / 4000
    got = c.near_lines(lines, 50 / 4000, 5 / 4000, 0.2, 0.025).where("line_ix = 364")
    assert [r.target for r in got.collect()] == [1200]


def test_near_lines_are_those_of_all_pairs(spark):
    rng = random.Random(5)
    rows = []
    for sheet in (1, 2):
        for ix in range(150):
            x, y, u, v = (rng.random() for _ in range(4))
            rows.append((sheet, ix, x, y, x + (u - x) / 5, y + (v - y) / 5))
        rows += [(sheet, 150, 0.5, 0.5, 0.5, 0.5), (sheet, 151, None, 0.5, 0.6, 0.5)]  # a point, and a line without a place
    rows += [(None, 1, 0.1, 0.1, 0.2, 0.1), (None, 2, 0.1, 0.1, 0.2, 0.1), (3, 0, None, None, None, None)]
    lines = spark.createDataFrame(rows, LINE)
    got = c.near_lines(lines, 0.03, 0.002, 0.2, 0.025)
    longer = c.with_extension(lines, 0.2)
    side = lambda p, n: longer.select("sheet_id", F.col("line_ix").alias(n), *[F.col(k).alias(f"{p}{k}") for k in ("x1", "y1", "x2", "y2", "ex1", "ey1", "ex2", "ey2")])
    a, b = g.box("_a"), g.box("_b")
    sl, el = g.point_segment(a.x1, a.y1, b), g.point_segment(a.x2, a.y2, b)
    both = side("_a", "line_ix").join(side("_b", "target"), "sheet_id").where("line_ix <> target").where((F.least(sl, el) < 0.03) & (g.segment_segment(g.box("_ae"), g.box("_be")) <= 0.004))
    apart = lambda x, y: F.least(F.hypot(x - b.x1, y - b.y1), F.hypot(x - b.x2, y - b.y2))
    every = both.select("sheet_id", "line_ix", "target", apart(a.x1, a.y1).alias("sp"), apart(a.x2, a.y2).alias("ep"), sl.alias("sl"), el.alias("el"))
    rounded = lambda df: sorted((r[0], r[1], r[2], *[round(v, 9) for v in r[3:]]) for r in df.collect())
    assert len(rounded(every)) > 100
    assert rounded(got) == rounded(every)


def test_lists_of_near_lines_are_folded_where_they_are_made(spark):
    rng = random.Random(8)
    point = lambda: (rng.randrange(40) / 40, rng.randrange(40) / 40)
    lines = spark.createDataFrame([(1, k, x, y, x + 0.1 * (k % 2), y + 0.1 * (1 - k % 2)) for k in range(160) for x, y in [point()]], LINE)
    boxes = lambda n, name: spark.createDataFrame([(1, k, x, y, x + 0.01, y + 0.01) for k in range(n) for x, y in [point()]], f"sheet_id long, {name} long, x1 double, y1 double, x2 double, y2 double")
    symbols, texts = boxes(20, "symbol_id"), boxes(20, "text_ix")
    found = c.candidates(lines, symbols, texts, 4000.0)
    assert "collect_list" not in found._jdf.queryExecution().executedPlan().toString()
    holders = c.first_holders(c.near_boxes(lines, symbols, "symbol_id", "symbol", 0, 0.003, 0.00125, 0.2, 0.025), c.near_boxes(lines, texts, "text_ix", "text", 1, 0.00125, 0.00125, 0.2, 0.025))
    folded = c.fold_lines(holders, c.near_lines(lines, 0.0125, 0.00125, 0.2, 0.025), lines, 0.0125, 0.0005)
    expected = {(r.line_ix, s): r[s].asDict() for r in folded.collect() for s in ("start", "end") if r[s].node is not None}
    got = {(r.line_ix, r.side): {"node": r.node, "type": r.type, "distance": r.distance, "intersection": r.intersection} for r in found.where("type <> 'symbol'").collect()}
    assert len(got) > 20 and got == {k: v for k, v in expected.items() if v["type"] != "symbol"}
