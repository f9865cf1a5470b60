"""Sheets drawn where they are read, and detectors and decoders that look at many lines or few rows together."""

import time

import numpy as np
import pytest

from sheetgraph.operators import raster as r
from sheetgraph.plans.all import QUERIES
from sheetgraph.sources import png


@pytest.mark.parametrize("name", ["m01_ink", "m02_masked", "m03_thinned", "m04_level_lines"])
def test_no_pixels_of_drawn_sheets_move(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert "pixels#" not in plan


def test_filters_that_change_with_each_row_are_undone_fast():
    rng = np.random.default_rng(1)
    rgb = rng.integers(0, 256, (200, 300, 3)).astype(np.uint8)
    content = png.encode(rgb, png.RGB, 8, filters=np.arange(200) % 5)
    began = time.process_time()
    assert (png.decode(content) == rgb).all()
    assert time.process_time() - began < 0.6


def test_many_lines_through_dense_ink():
    """Random strokes: most lines through them hold no part long enough, and are left out together."""
    rng, mask = np.random.default_rng(2), np.zeros((300, 400), bool)
    for y, x, n in zip(rng.integers(0, 300, 1500).tolist(), rng.integers(0, 400, 1500).tolist(), rng.integers(3, 26, 1500).tolist(), strict=True):
        mask[y, x : x + n] = True
        mask[y // 2 : y // 2 + n, x] = True
    began = time.process_time()
    found = r.segments(mask, votes=40, least=12)
    took = time.process_time() - began
    assert len(found) > 500 and took < 2
