"""What a sheet holds moves by sheet alone: rows are repeated for their cells, joined and counted where they lie."""

import re

import pytest

from sheetgraph.plans.all import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def joined_by_moves(spark):
    """No table is small enough to be sent to all tasks, as those of many sheets are not."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["h01_candidates", "gr05_arrow_directions", "j08_arrow_lines", "r02_segment_disposition", "f04_boxed", "j09_crossings"])
def test_rows_move_by_sheet_alone(joined_by_moves, name):
    plan = QUERIES[name](joined_by_moves, SF)._jdf.queryExecution().executedPlan().toString()
    moves = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert moves and all(re.fullmatch(r"sheet_id#\d+L", m) for m in moves), moves
