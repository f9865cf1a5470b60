"""Text detections that mean one thing: duplicates of tiles, and stacked lines of one label."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetgraph.functions import geometry as g
from sheetgraph.functions import text as t
from sheetgraph.operators.components import connected_components
from sheetgraph.operators.spatial import box_join

C4 = ("x1", "y1", "x2", "y2")


def _pairs(df: DataFrame, key: list[str], item: str, extra: list[str], reach: float, cell: float) -> DataFrame:
    side = lambda p: df.select(*key, F.col(item).alias(f"{p}_id"), *[F.col(c).alias(f"_{p}_{c}") for c in (*C4, *extra)])
    return box_join(side("a"), side("b"), key, tuple(g.box("_a_")), tuple(g.box("_b_")), reach, cell).where("a_id < b_id")


def _grouped(df: DataFrame, pairs: DataFrame, key: list[str], item: str) -> DataFrame:
    node = lambda c: F.struct(*key, F.col(c).alias("id"))
    comp = connected_components(pairs.select(node("a_id").alias("a"), node("b_id").alias("b"))).select(*[F.col(f"node.{k}").alias(k) for k in key], F.col("node.id").alias(item), F.col("component.id").alias("cluster"))
    return df.join(comp, [*key, item], "left").withColumn("cluster", F.coalesce("cluster", item))


def same_regions(df: DataFrame, key: list[str], item: str, iou: float = 0.2, contained: float = 0.6, cell: float = 200.0) -> DataFrame:
    """(a_id, b_id) of detections of one region: they overlap by iou, or one holds most of the other."""
    a, b = g.box("_a_"), g.box("_b_")
    p = _pairs(df, key, item, [], 0.0, cell)
    return p.where((g.iou(a, b) > iou) | (g.contained_share(a, b) > contained) | (g.contained_share(b, a) > contained)).select(*key, "a_id", "b_id")


def deduplicated(df: DataFrame, key: list[str], item: str, text: str, score: str, **limits) -> DataFrame:
    """The detection of largest length x score of each cluster of same regions; ties go to the first."""
    grouped = _grouped(df, same_regions(df, key, item, **limits), key, item)
    best = grouped.groupBy(*key, "cluster").agg(F.max_by(F.struct(*df.columns), F.struct(F.length(text) * F.col(score), -F.col(item))).alias("r"))
    return best.select("r.*")


def stacked(df: DataFrame, key: list[str], item: str, text: str, gap: float = 10.0, overlap: float = 0.8, longest: int = 12, cell: float = 200.0) -> DataFrame:
    """(a_id, b_id) of lines of one label: close one above the other, aligned, short, and neither a whole tag."""
    a, b = g.box("_a_"), g.box("_b_")
    p = _pairs(df, key, item, [text], gap, cell)
    upper_first = a.y1 <= b.y1
    space = F.when(upper_first, b.y1 - a.y2).otherwise(a.y1 - b.y2)
    width = F.least(a.x2 - a.x1, b.x2 - b.x1)
    share = F.when(width > 0, F.greatest(g.zero(), F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)) / width).otherwise(g.zero())
    ta, tb = F.trim(f"_a_{text}"), F.trim(f"_b_{text}")
    part = lambda x: ~t.is_equipment_tag(x) & (F.length(x) <= longest)
    return p.where((space <= gap) & (share > overlap) & part(ta) & part(tb)).select(*key, "a_id", "b_id")


def merged_lines(df: DataFrame, key: list[str], item: str, text: str, score: str, most: int = 3, **limits) -> DataFrame:
    """Labels: the lines of a stack of up to `most` joined from the top, with their box, best score and count; longer stacks stay apart."""
    grouped = _grouped(df, stacked(df, key, item, text, **limits), key, item)
    n = F.count("*").over(Window.partitionBy(*key, "cluster"))
    unit = F.when(n > most, F.col(item)).otherwise(F.col("cluster"))
    line = F.struct("y1", "x1", item, F.col(text).alias("text"))
    return grouped.withColumn("_u", unit).groupBy(*key, F.col("_u").alias(item)).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["text"]), " ").alias(text),
        F.max(score).alias(score),
        F.min("x1").alias("x1"),
        F.min("y1").alias("y1"),
        F.max("x2").alias("x2"),
        F.max("y2").alias("y2"),
        F.count("*").alias("count"),
    )
