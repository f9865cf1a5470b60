"""Runs are stitched once, however often they are read on the way to points, edges and links."""

import pytest

from sheetgraph.operators import crossing as x
from sheetgraph.plans import crossings, job
from sheetgraph.plans.all import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["w01_chained_points", "g08_merged_points", "gr13_symbol_links", "gr16_grown_component", "gr16_scattered", "s17_sheet_job"])
def test_segments_are_read_once(spark, monkeypatch, name):
    plans, real, write = [], x.stash, job.p.write_json
    text = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    noted = lambda df, name="stage": plans.append(text(df)) or real(df, name)
    for module in (x, crossings, job):
        monkeypatch.setattr(module, "stash", noted, raising=False)
    monkeypatch.setattr(job.p, "write_json", lambda df, path: plans.append(text(df)) or write(df, path))
    plans.append(text(QUERIES[name](spark, SF)))
    # of its two reads of segments, marking boxed ones takes the one and what is marked the other
    assert sum(p.count("Relation [l_orderkey") for p in plans) == 2


def test_chained_points_are_told_with_their_place(spark):
    """What chain() gives needs no join with the entries to tell where it lies."""
    plan = QUERIES["w01_chained_points"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "Join" not in plan
