"""Extended lines of every slope, against plain Python."""

from sheetgraph.plans.all import QUERIES
from sheetgraph.sources import derived as d

SF = "/root/testdata/sf0.001"


def _extended(x1, y1, x2, y2):
    if x1 == x2:
        return x1, x2, max(y1 - 0.2, 0)
    left = max(x1 - 0.2, 0)
    return left, min(x2 + 0.2, 1), y1 + (y2 - y1) / (x2 - x1) * (left - x1)


def test_every_line(spark):
    rows = {(r.sheet_id, r.line_ix): (r.x1 / 4000, r.y1 / 3000, r.x2 / 4000, r.y2 / 3000) for r in d.lines(spark, SF).collect()}
    got = {(r.sheet_id, r.line_ix): r for r in QUERIES["l01_extended"](spark, SF).collect()}
    assert got.keys() == rows.keys()
    assert any(x1 != x2 and y1 != y2 for x1, y1, x2, y2 in rows.values())
    for k, line in rows.items():
        assert got[k].upright == (line[0] == line[2])
        assert all(abs(a - b) < 1.1e-5 for a, b in zip((got[k].x1, got[k].x2, got[k].y1), _extended(*line), strict=True)), (k, line)
