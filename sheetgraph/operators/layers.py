"""Two layers of one sheet: runs rejoined across them, and what a crossing lies between."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetgraph.operators.crossing import fragment_groups


def load_layer(runs: DataFrame, layer: str, ids: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """A layer's rows, marked with it, their ids prefixed by it."""
    return runs.withColumns({c: F.concat(F.lit(f"{layer}:"), F.col(c).cast("string")) for c in ids}).withColumn("layer", F.lit(layer))


def rejoined(runs: DataFrame, key: list[str], pos_tol: float, gap: float) -> DataFrame:
    """Runs (run_id, axis, pos, lo, hi, dashed, layer) joined with collinear neighbours of either layer.

    One that spans layers is of "both"; it is dashed if any part is; its place is weighted by length.
    """
    grouped = fragment_groups(runs, key, pos_tol, gap, "run_id")
    ink = F.col("hi") - F.col("lo") + 1
    return grouped.groupBy(*key, "axis", F.col("piece_of").alias("run_id")).agg(
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        (F.sum(F.col("pos") * ink) / F.sum(ink)).alias("pos"),
        F.bool_or("dashed").alias("dashed"),
        F.when(F.count_distinct("layer") > 1, F.lit("both")).otherwise(F.min("layer")).alias("layer"),
    )


def neighbours_along(entries: DataFrame, key: list[str]) -> DataFrame:
    """entries (run_id, at, point_id, symbols) with the symbols next before and after each point along its run."""
    w = Window.partitionBy(*key, "run_id").orderBy("at", "point_id")
    held = F.when(F.size("symbols") > 0, F.col("symbols"))
    before = F.last(held, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(held, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return entries.withColumns({"before": before, "after": after})


def cross_layer_points(entries: DataFrame, runs: DataFrame, key: list[str]) -> DataFrame:
    """Points whose runs are of more than one layer."""
    return entries.join(runs.select(*key, "run_id", "layer"), [*key, "run_id"]).groupBy(*key, "point_id").agg(F.array_sort(F.collect_set("layer")).alias("layers")).where(F.size("layers") > 1)
