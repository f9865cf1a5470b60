import math

import pytest
from pyspark.sql import functions as F

from sheetgraph.functions import geometry as g


def box(*v):
    return g.Box(*[F.lit(float(x)) for x in v])


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


CASES = [
    (lambda: g.iou(box(0, 0, 2, 2), box(1, 1, 3, 3)), 1 / 7),
    (lambda: g.iou(box(0, 0, 1, 1), box(1, 0, 2, 1)), 0.0),
    (lambda: g.iou(box(0, 0, 0, 0), box(0, 0, 0, 0)), 0.0),
    (lambda: g.contained_share(box(0, 0, 1, 1), box(0, 0, 5, 5)), 1.0),
    (lambda: g.gap(box(0, 0, 1, 1), box(4, 5, 6, 6)), 5.0),
    (lambda: g.slope(box(1, 0, 1, 5)), math.inf),
    (lambda: g.slope(box(0, 0, 2, 1)), 0.5),
    (lambda: g.orientation(box(0, 0, 0, 0), 5), None),
    (lambda: g.orientation(box(0, 0, 100, 3), 5), "h"),
    (lambda: g.orientation(box(0, 0, 50, 50), 5), None),
    (lambda: g.point_segment(F.lit(1.0), F.lit(1.0), box(0, 0, 2, 0)), 1.0),
    (lambda: g.point_segment(F.lit(3.0), F.lit(4.0), box(0, 0, 0, 0)), 5.0),
    (lambda: g.segment_segment(box(0, 0, 2, 2), box(0, 2, 2, 0)), 0.0),
    (lambda: g.segment_segment(box(0, 0, 1, 0), box(3, 0, 4, 0)), 2.0),
    (lambda: g.segment_box(box(-1, 0.5, 5, 0.5), box(1, 0, 2, 1)), 0.0),
    (lambda: g.segment_box(box(0, 0, 0, 5), box(3, 1, 4, 2)), 3.0),
    (lambda: g.segment_box(box(0, 3, 3, 0), box(2, 2, 3, 3)), math.sqrt(0.5)),
    (lambda: g.ray_box(F.lit(0.0), F.lit(0.5), F.lit(1.0), F.lit(0.0), box(2, 0, 3, 1)), 2.0),
    (lambda: g.ray_box(F.lit(2.5), F.lit(0.5), F.lit(1.0), F.lit(0.0), box(2, 0, 3, 1)), 0.0),
    (lambda: g.ray_box(F.lit(5.0), F.lit(0.5), F.lit(1.0), F.lit(0.0), box(2, 0, 3, 1)), None),
    (lambda: g.ray_box(F.lit(0.0), F.lit(5.0), F.lit(1.0), F.lit(0.0), box(2, 0, 3, 1)), None),
    (lambda: g.extended(box(0.5, 0.5, 0.7, 0.6), 0.2).y1, 0.4),
    (lambda: g.extended(box(0.1, 0.5, 0.9, 0.5), 0.2).x1, 0.0),
    (lambda: g.extended(box(0.5, 0.1, 0.5, 0.9), 0.2).y2, 1.0),
    (lambda: g.axis_overlap(box(0, 0, 10, 1), box(10, 0, 20, 1), "h", 0.0), True),
    (lambda: g.axis_overlap(box(0, 0, 10, 1), box(11, 0, 20, 1), "h", 0.0), False),
    (lambda: g.to_pixels(F.lit(-0.55), 10.0), -5),
    (lambda: g.iou(g.Box(F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0), F.lit(1.0)), box(0, 0, 1, 1)) >= 0, None),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_value(spark, k):
    make, expected = CASES[k]
    got = value(spark, make())
    if k == len(CASES) - 1:
        return  # a null coordinate must not fail
    assert got == pytest.approx(expected) if isinstance(expected, float) else got == expected


def test_invalid_box_is_an_error(spark):
    with pytest.raises(Exception, match="not within 0 to 1"):
        value(spark, g.checked(box(0, 0, 2, 1), F.lit(1)))
