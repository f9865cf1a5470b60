"""Layers and tiles of drawn images: no pixels move, and a task has one tile at a time."""

from sheetgraph.operators import raster as r
from sheetgraph.operators import tiles as tl
from sheetgraph.plans.all import QUERIES
from sheetgraph.sources import images as im

SF = "/root/testdata/sf0.001"


def test_no_pixels_move(spark):
    for name in ("m06_layers", "m12_tiles"):
        assert "pixels#" not in QUERIES[name](spark, SF)._jdf.queryExecution().analyzed().toString()


def test_layers_are_those_of_stored_tiles(spark):
    grid = tl.Grid(300, 400, 128, 24)
    each = r.image_stage(lambda t: [{"sheet_id": t["sheet_id"], "tx": t["tx"], "ty": t["ty"], "layer": t["layer"], "n": int((r.pixels(t)[tl.owned(grid, t)] == 255).sum())}], "sheet_id long, tx int, ty int, layer string, n long")
    both = [sorted(map(tuple, each(tl.split_layers(tl.cut(images, 128, 24), grid)).collect())) for images in (im.drawn(spark, SF), im.sheets_on_reading(spark, SF))]
    assert both[0] == both[1] and len(both[0]) == 3 * 12 * 2
