"""Tiles drawn where they are read: the same results as from stored ones, and no pixels in any exchange."""

import numpy as np
import pytest

from sheetgraph.operators import raster as r
from sheetgraph.operators import templates as tm
from sheetgraph.operators import tiles as tl
from sheetgraph.plans.all import QUERIES
from sheetgraph.sources import images as im

GRID = tl.Grid(150, 220, 64, 16)
STROKE = "sheet_id long, axis string, pos long, lo long, hi long, red boolean, dash int, gap int, base long"


@pytest.fixture(scope="module")
def strokes(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(120):
        lo = int(rng.integers(-20, 200))
        rows.append((k % 3, "hv"[k % 2], int(rng.integers(-5, 230)), lo, lo + int(rng.integers(0, 120)), k % 5 == 0, 8 if k % 4 == 0 else None, 5 if k % 4 == 0 else None, 0))
    return spark.createDataFrame(rows, STROKE)


@pytest.fixture(scope="module")
def both(strokes):
    return im.drawn_tiles(strokes, GRID), im.drawn_on_reading(strokes, GRID)


@pytest.mark.parametrize("name", ["m12_full_tiles", "m07_supported_gaps"])
def test_no_pixels_move(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "pixels" not in plan


def test_same_as_stored_tiles(spark, strokes, both):
    rng = np.random.default_rng(4)
    rows = [(k % 3, k, "hv"[k % 2], int(rng.integers(-9, 230)), int(lo), int(lo + rng.integers(0, 90))) for k, lo in enumerate(rng.integers(-20, 210, 150))]
    spans = spark.createDataFrame(rows, "sheet_id long, span_id long, axis string, level long, lo long, hi long")
    for make in (lambda t: tl.evidence(t, spans, GRID, share=0.5), lambda t: tl.profiles(t, spans, GRID), lambda t: tl.components(t, GRID, least=3), lambda t: tl.measured(t, GRID, lambda p: {"ink": int(r.ink(r.gray(p)).sum())}, "ink long")):
        stored, drawn = (sorted(map(tuple, make(t).collect())) for t in both)
        assert stored == drawn and len(stored) > 2


def test_spans_and_strokes_of_one_table(spark, strokes):
    """A cogroup whose sides come from one table, as in l05."""
    spans = strokes.where("hi > lo").selectExpr("sheet_id", "monotonically_increasing_id() as span_id", "axis", "pos as level", "lo", "hi")
    seen = tl.evidence(im.drawn_on_reading(strokes, GRID), spans, GRID)
    assert seen.where("evidence").count() > 0


def test_white_and_gray_pixels_are_told_alike():
    rng = np.random.default_rng(5)
    rgb = rng.integers(0, 256, (40, 50, 3)).astype(np.uint8)
    rgb[:10] = 255
    rgb[10:20] = rgb[10:20, :, :1]
    assert (r.gray(rgb) == np.rint(rgb @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)).all()
    assert not r.red(rgb)[:20].any() and r.red(rgb)[20:].any()


def test_plates_and_crops_as_stored(spark):
    """Symbols, and crops over several tiles, at the sheet's edge and on paper, of tiles drawn where they are read."""
    sf, grid = "/root/testdata/sf0.001", tl.Grid(1500, 2000, 512, 64)
    stored, drawn = im.plates(spark, sf, grid).cache(), im.plates_on_reading(spark, sf, grid)
    assert "pixels" not in str(drawn.rows.schema)
    sheet = stored.agg({"sheet_id": "min"}).first()[0]
    boxes = spark.createDataFrame([(sheet, 7, 400, 400, 530, 520), (sheet, 8, -30, -30, 20, 20), (sheet, 9, 1990, 1490, 1999, 1499), (sheet, 10, 900, 900, 1000, 980), (-5, 11, 0, 0, 9, 9)], "sheet_id long, crop_id long, x1 long, y1 long, x2 long, y2 long")
    whole = tm.crops(stored, boxes, grid, 128)
    made = tm.crops(drawn, boxes, grid, 128).over(lambda t: [t | {"pixels": t["pixels"].tobytes()}], "sheet_id long, crop_id long, x int, y int, height int, width int, pixels binary")
    a, b = ({r.crop_id: tuple(r) for r in df.collect()} for df in (whole, made))
    assert a == b and sorted(a) == [7, 8, 9, 10, 11]
    widths = spark.createDataFrame([(sheet, 14)], "sheet_id long, template int")
    found = [sorted(map(tuple, tm.detect(tl.told(t, widths, "template", 28), grid, im.glyph, im.CLASSES, "template", 0.85).collect())) for t in (stored, drawn)]
    assert found[0] == found[1] and found[0]
