"""A job over image files: cut off and taken up again, changed and broken sheets."""

import numpy as np
import pytest

from sheetgraph.plans import resume
from sheetgraph.sources import png

SYMBOL, TEXT = "sheet_id long, symbol_id long, x1 long, y1 long, x2 long, y2 long", "sheet_id long, text_ix long, x1 long, y1 long, x2 long, y2 long"


def sheet(k):
    p = np.full((90, 160), 255)
    p[20 + k, 20:140] = 0
    p[10:80, 60 + k] = 0
    p[60, 40:120] = 0
    return png.encode(p, png.GRAY, 8)


def tables(spark, broken=(), changed=()):
    rows = [(k, b"no image" if k in broken else sheet(k + 7 if k in changed else k)) for k in range(4)]
    files = spark.createDataFrame(rows, "sheet_id long, content binary")
    symbols = spark.createDataFrame([(k, 1, 5, 15, 22, 30) for k in range(4)] + [(k, 2, 138, 12, 155, 32) for k in range(4)], SYMBOL)
    texts = spark.createDataFrame([(k, 1, 70, 70, 80, 75) for k in range(4)], TEXT)
    return files, symbols, texts


def stored(spark, out):
    return sorted(r.value for r in spark.read.text(f"{out}/viewer").collect())


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    out = f"file://{tmp_path_factory.mktemp('whole')}"
    resume.sheets(spark, *tables(spark), out)
    return out, stored(spark, out)


def test_whole(spark, whole):
    out, lines = whole
    assert len(lines) == 4
    graph = resume.Job(spark, out).results("graph").orderBy("sheet_id").collect()
    for k, r in enumerate(graph):
        assert sorted((x.axis, round(x.pos)) for x in r.runs) == [("h", 20 + k), ("h", 60), ("v", 60 + k)]
        assert [(x.a, x.b) for x in r.links] == [(1, 2)]


def test_taken_up_again(spark, whole, tmp_path, monkeypatch):
    """After a stop, the first stage is not computed again and the results are the same bytes."""
    out = f"file://{tmp_path}"
    half = resume.sheets(spark, *tables(spark), out, upto="strokes")
    assert half.manifest().groupBy("stage").count().collect()[0].asDict() == {"stage": "strokes", "count": 4}

    def no(*_):
        raise AssertionError("a finished stage is computed again")

    monkeypatch.setattr(resume, "strokes_of_files", no)
    resume.sheets(spark, *tables(spark), out)
    assert stored(spark, out) == whole[1]


def test_a_lost_run_is_not_read(spark, whole, tmp_path):
    """Results without an entry in the manifest, as a run that died leaves them, are computed again and never read twice."""
    out = f"file://{tmp_path}"
    job = resume.Job(spark, out)
    resume.strokes_of_files(tables(spark)[0]).write.parquet(f"{out}/strokes/run=lost")
    resume.sheets(spark, *tables(spark), out)
    assert stored(spark, out) == whole[1] and job.results("strokes").count() == 12


def test_changed_and_broken_sheets(spark, whole, tmp_path):
    """A broken sheet goes to the side table and the others go on; when it is mended only it is computed."""
    out = f"file://{tmp_path}"
    job = resume.sheets(spark, *tables(spark, broken=(2,)), out, upto="strokes")
    assert [(r.sheet_id, r.stage, r.error) for r in job.failed().collect()] == [(2, "strokes", "ValueError: not a PNG file")]
    assert {r.sheet_id for r in job.results("strokes").collect()} == {0, 1, 3}
    before = {r.sheet_id: r.run for r in job.manifest().collect()}
    resume.sheets(spark, *tables(spark), out)
    after = {r.sheet_id: r.run for r in job.manifest().where("stage = 'strokes'").collect()}
    assert {k for k in after if after[k] != before[k]} == {2} and job.failed().isEmpty()
    assert stored(spark, out) == whole[1]
    changed = resume.sheets(spark, *tables(spark, changed=(1,)), f"{out}/other")
    assert changed.results("strokes").where("sheet_id = 1 and axis = 'h'").select("pos").collect()[0].pos in (28.0, 60.0)


def test_fingerprints(spark):
    rows = [(1, "a", 2), (1, "b", 3), (2, "a", 2)]
    mark = lambda r: {x.sheet_id: x.input for x in resume.fingerprints({"t": spark.createDataFrame(r, "sheet_id long, s string, n int")}).collect()}
    base = mark(rows)
    assert mark(rows[::-1]) == base and base[1] != base[2]
    assert mark([*rows, rows[0]])[1] != base[1] and mark([(1, "a", 2), (1, "b", 4), (2, "a", 2)])[1] != base[1]
    assert mark([(1, None, 2), (2, "a", 2)])[2] == base[2]
