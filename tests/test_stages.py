import json

import numpy as np
import pytest

from sheetgraph.config import EngineConfig
from sheetgraph.operators import raster as ra
from sheetgraph.plans.stages import read_through
from sheetgraph.sources import payload as p
from sheetgraph.streaming.sheets import read_stream, run_stream

SHEET = {"image_url": "a.png", "image_details": {"format": "png", "width": 10, "height": 5}, "all_text_list": [{"topX": 0, "topY": 0, "bottomX": 1, "bottomY": 1, "text": "V1"}], "text_and_symbols_associated_list": []}


def test_config_rules():
    assert EngineConfig(detect_dotted=True).max_gap_px == 10 and EngineConfig(detect_dotted=True).min_line_px is None
    assert EngineConfig(min_line_px=3).min_line_px == 10 and EngineConfig(max_gap_px=4).max_gap_px is None
    assert EngineConfig(flow_prefixes="a, b,a").flow_prefixes == ("a", "b")


def test_payload_files_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("s1", "s2"):
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps(SHEET, indent=1))
    sheets = p.read_json(spark, str(tmp_path / "in"), p.DETECTIONS)
    assert sorted((r.sheet_id, r.text_ix, r.text) for r in p.texts_of(sheets).collect()) == [("s1", 0, "V1"), ("s2", 0, "V1")]
    assert p.symbols_of(sheets).count() == 0
    q = run_stream(read_stream(spark, str(tmp_path / "in")), p.texts_of, str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_read_through(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert read_through(spark, path, lambda: spark.range(3)).count() == 3
    assert read_through(spark, path, lambda: spark.range(9)).count() == 3
    assert read_through(spark, path, lambda: spark.range(9), valid=lambda d: False).count() == 9


def test_stored_box_beyond_sheet(spark):
    a = spark.createDataFrame([("s", "t", 1.0, 0.0, 0.0, 20.0, 1.0)], "sheet_id string, tag string, confidence double, x1 double, y1 double, x2 double, y2 double")
    sizes = spark.createDataFrame([("s", 10, 10)], "sheet_id string, width int, height int")
    with pytest.raises(Exception, match="beyond its sheet"):
        p.stored_results(a, None, sizes).collect()


def test_png_and_class_names(spark, tmp_path):
    header = b"\x89PNG\r\n\x1a\n" + (13).to_bytes(4, "big") + b"IHDR" + (3916).to_bytes(4, "big") + (2572).to_bytes(4, "big")
    (tmp_path / "a.png").write_bytes(header)
    r = p.png_sizes(spark.read.format("binaryFile").load(str(tmp_path / "a.png"))).first()
    assert (r.width, r.height) == (3916, 2572)
    assert p.class_names("path: x\nnames:\n  0: Gate_Valve  # a\n  1: 'box'\nother: 1\n") == {0: "Gate_Valve", 1: "box"}


def test_raster():
    m = np.zeros((9, 20), bool)
    m[3:6, 2:18] = True
    t = ra.thinned(m)
    assert t.any() and (t <= m).all() and t.sum(axis=0).max() == 1
    assert ra.thinned(m, 1).sum() < m.sum()
    rgb = np.full((8, 8, 3), 255, np.uint8)
    rgb[1:5, 1:5] = (200, 10, 10)
    assert ra.red(rgb).sum() == 16 and ra.blobs(ra.red(rgb))[0] == {"area": 16, "x1": 1, "y1": 1, "x2": 5, "y2": 5, "cx": 2.5, "cy": 2.5}
    assert ra.blobs(np.zeros((3, 3), bool)) == []
    v = np.full((6, 6), 255, np.uint8)
    v[2, :] = 0
    assert ra.ink(v).sum() == 6 and ra.ink(v, 0).sum() == 6 and ra.background(v) == 255
    assert ra.masked(v, np.array([[0, 0, 6, 6]]), 1)[2].tolist() == [0, 255, 255, 255, 255, 0]
    assert ra.supported(ra.ink(v), "h", 4, 0, 6) and not ra.supported(ra.ink(v), "h", 40, 0, 6)
    assert ra.stroke_profile(ra.ink(v), "h", 3, 0, 6).all()


def test_image_stage(spark):
    df = spark.createDataFrame([("a", bytes([0, 255, 0, 255]))], "name string, data binary")
    stage = ra.image_stage(lambda r: [{"name": r["name"], "dark": int((np.frombuffer(bytes(r["data"]), np.uint8) < 128).sum())}], "name string, dark int")
    assert stage(df).first().dark == 2
