"""Stroke runs, chunks and dash verdicts of every segment, against plain Python."""

from itertools import groupby
from statistics import median

from sheetgraph.plans.all import QUERIES
from sheetgraph.sources import derived as d

SF = "/root/testdata/sf0.001"


def _runs(row):
    ink = [(row.lo + 7 * k, (k % 8 < 5 if row.line_ix % 2 == 0 else k % 5 < 2) or row.line_ix % 11 == 0) for k in range(40)]
    return [(bool(i), g[0][0], len(g)) for i, g in ((i, list(g)) for i, g in groupby(ink, key=lambda x: x[1]))]


def test_every_segment(spark):
    want = {(r.sheet_id, r.line_ix): _runs(r) for r in d.segments(spark, SF).collect()}
    got = QUERIES["w05_stroke_runs"](spark, SF).collect()
    assert sorted((r.sheet_id, r.line_ix, r.ink, r.first, r.length) for r in got) == sorted((*k, *x) for k, v in want.items() for x in v)
    inner = {k: v[1:-1] for k, v in want.items() if len(v) > 2}
    got = QUERIES["w06_dash_chunks"](spark, SF).collect()
    assert sorted((r.sheet_id, r.line_ix, r.ink, r.first, r.length) for r in got) == sorted((*k, *x) for k, v in inner.items() for x in v)
    mid = lambda v, ink: median(x[2] for x in v if x[0] == ink)
    # lengths are the same in every chunk of these profiles, so only the medians and the number of gaps count
    fits = lambda v: sum(not x[0] for x in v) >= 2 and 2 <= mid(v, False) <= 25 and 4 <= mid(v, True) <= 60
    got = QUERIES["ag11_dash_verdicts"](spark, SF).collect()
    assert sorted((r.sheet_id, r.line_ix, r.dash, r.gap, r.dashed) for r in got) == sorted((*k, mid(v, True), mid(v, False), fits(v)) for k, v in inner.items())
