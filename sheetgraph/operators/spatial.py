"""Joins by place: every one has the sheet and a grid cell as equi-join keys.

A pair that shares several cells is taken in one of them only, so no distinct is needed.
Rows move once, by sheet, before they are repeated for their cells; what follows by sheet finds them there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def moved(df: DataFrame, key: list[str]) -> DataFrame:
    """df with the rows of a key in one partition. A table that lies so already does not move again.

    Joins by the key and more columns then find both sides in place, which Spark must be allowed to use. A union counts as
    scattered (Spark 4.1 may take its parts for one table's partitions and then fail), so one that goes on by key is moved.
    """
    df.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    df.sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    return df.repartition(*key)


def _cells(lo: Column, hi: Column, width: float) -> Column:
    return F.sequence(F.floor(lo / width), F.floor(hi / width))


def band_join(points: DataFrame, bands: DataFrame, key: list[str], pos: Column, lo: Column, hi: Column, width: float) -> DataFrame:
    """Pairs with lo <= pos <= hi; pos is of `points`, lo and hi of `bands`. Other columns must have different names."""
    p = points.withColumn("_cell", F.floor(pos / width)).withColumn("_pos", pos)
    b = bands.withColumn("_lo", lo).withColumn("_hi", hi).where("_lo <= _hi").withColumn("_cell", F.explode(_cells(F.col("_lo"), F.col("_hi"), width)))
    return p.join(b, [*key, "_cell"]).where((F.col("_pos") >= F.col("_lo")) & (F.col("_pos") <= F.col("_hi"))).drop("_cell", "_pos", "_lo", "_hi")


def box_join(a: DataFrame, b: DataFrame, key: list[str], box_a: tuple, box_b: tuple, reach: float, cell: float) -> DataFrame:
    """Pairs whose boxes come within `reach` on both axes (a superset of those within that distance).

    box_a and box_b are (x1, y1, x2, y2) of columns. Other columns must have different names.
    """

    def placed(df: DataFrame, box: tuple, margin: float, side: str) -> DataFrame:
        x1, y1, x2, y2 = (c.cast("double") for c in box)
        df = df.withColumns({f"_{side}x1": x1 - margin, f"_{side}y1": y1 - margin, f"_{side}x2": x2 + margin, f"_{side}y2": y2 + margin})
        df = df.withColumn("_cx", F.explode(_cells(F.col(f"_{side}x1"), F.col(f"_{side}x2"), cell)))
        return df.withColumn("_cy", F.explode(_cells(F.col(f"_{side}y1"), F.col(f"_{side}y2"), cell)))

    joined = placed(moved(a, key), box_a, reach, "a").join(placed(moved(b, key), box_b, 0.0, "b"), [*key, "_cx", "_cy"])
    near = (F.col("_ax1") <= F.col("_bx2")) & (F.col("_bx1") <= F.col("_ax2")) & (F.col("_ay1") <= F.col("_by2")) & (F.col("_by1") <= F.col("_ay2"))
    once = (F.col("_cx") == F.floor(F.greatest("_ax1", "_bx1") / cell)) & (F.col("_cy") == F.floor(F.greatest("_ay1", "_by1") / cell))
    return joined.where(near & once).drop("_cx", "_cy", *[f"_{s}{c}" for s in "ab" for c in ("x1", "y1", "x2", "y2")])


def nearest(pairs: DataFrame, key: list[str], distance: str, order: list[str]) -> DataFrame:
    """The row of least distance of each key; ties go to the first by `order`. Runs as a partial aggregate."""
    rest = [c for c in pairs.columns if c not in key]
    best = pairs.groupBy(*key).agg(F.min(F.struct(F.col(distance).alias("_d"), *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)], F.struct(*rest).alias("_row"))).alias("_best"))
    return best.select(*key, "_best._row.*")


def islands(df: DataFrame, key: list[str], lo: str, hi: str, gap: float, name: str = "island", ties: list[str] | None = None) -> DataFrame:
    """df with the number of its island: a new one starts where lo lies more than `gap` beyond all hi before it."""
    w = Window.partitionBy(*key).orderBy(lo, *(ties or []))
    reach = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    start = F.when(reach.isNull() | (F.col(lo) - reach > gap), 1).otherwise(0)
    return df.withColumn("_start", start).withColumn(name, F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("_start")
