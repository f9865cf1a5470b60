"""Drawn tiles: strokes move once, and a pixel takes a byte."""

import numpy as np

from sheetgraph.operators import raster as r
from sheetgraph.operators import tiles as tl
from sheetgraph.sources import images as im

GRID = tl.Grid(150, 220, 64, 16)
STROKE = "sheet_id long, axis string, pos long, lo long, hi long, red boolean, dash int, gap int, base long"


def rows(seed, n=60):
    rng = np.random.default_rng(seed)
    return [(k % 2, "hv"[int(rng.integers(2))], int(rng.integers(0, 150)), int(lo), int(lo + rng.integers(1, 190)), k % 3 > 0, 8 if k % 4 == 0 else None, 5 if k % 4 == 0 else None, 0) for k, lo in enumerate(rng.integers(-20, 150, n))]


def test_strokes_move_once(spark):
    strokes = spark.createDataFrame(rows(1), STROKE)
    drawn = im.drawn_on_reading(strokes, GRID)
    assert drawn.rows.count() == 60
    tile = next(iter(drawn.draw(strokes.where("sheet_id = 0").toPandas())))
    assert isinstance(tile["pixels"], r.Indexed) and tile["pixels"].numbers.nbytes == 64 * 64


def test_colours_are_told_once():
    rng = np.random.default_rng(2)
    image = r.Indexed(rng.integers(0, 4, (20, 30)).astype(np.uint8), rng.integers(0, 256, (4, 3)).astype(np.uint8))
    plain = np.asarray(image)
    assert (r.gray(image) == r.gray(plain)).all() and (r.red(image) == r.red(plain)).all()
    assert (r.gray(image[3:9, ::2]) == r.gray(plain)[3:9, ::2]).all() and image.shape == plain.shape
