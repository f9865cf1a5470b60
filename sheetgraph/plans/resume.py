"""Jobs over sheets that can be cut off and taken up again, sheet by sheet and stage by stage.

A stage's inputs are told apart by a hash of each sheet's rows. Sheets whose hash the manifest holds are skipped by
an anti-join; the others are computed, their results written to a folder of their own, and only then entered into the
manifest. A run that ends before that leaves a folder that nobody reads. Sheets that a stage can't do go to a side
table with the reason, and the job goes on; they are tried again when their input changes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetgraph.operators import crossing as x
from sheetgraph.operators import raster as r
from sheetgraph.plans import job
from sheetgraph.plans.crossings import _RUNS, fragments
from sheetgraph.plans.registry import query
from sheetgraph.plans.stages import exists
from sheetgraph.sources import payload as p

ENTRY = "sheet_id bigint, stage string, input string, run string, error string"


def fingerprints(inputs: dict[str, DataFrame]) -> DataFrame:
    """(sheet_id, input): a hash of each sheet's rows in all tables, whatever their order; copies of a row count."""
    sums = []
    for name, df in sorted(inputs.items()):
        row = F.to_json(F.struct(F.lit(name).alias("_"), *[F.base64(c).alias(c) if df.schema[c].dataType.simpleString() == "binary" else F.col(c) for c in sorted(df.columns)]))
        sums.append(df.select("sheet_id", *[F.conv(F.substring(F.sha2(row, 256), at, 15), 16, 10).cast("decimal(38,0)").alias(f"h{at}") for at in (1, 16)]))
    rows = reduce(DataFrame.unionByName, sums)
    return rows.groupBy("sheet_id").agg(F.sha2(F.concat_ws(":", F.sum("h1"), F.sum("h16"), F.count("*")), 256).alias("input"))


class Job:
    """Results of named stages under a folder: <out>/<stage>/<run>, and <out>/manifest."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")

    def manifest(self) -> DataFrame:
        """The last entry of each sheet and stage."""
        path = f"{self.out}/manifest"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], ENTRY)
        rows = self.spark.read.schema(f"{ENTRY}, at bigint").parquet(path)
        last = Window.partitionBy("sheet_id", "stage").orderBy(F.col("at").desc(), "run")
        return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "at")

    def results(self, stage: str) -> DataFrame:
        """All rows of a stage, of the run that the manifest names for each sheet."""
        own = self.manifest().where((F.col("stage") == stage) & F.col("error").isNull()).select("sheet_id", "run")
        return self.spark.read.option("basePath", f"{self.out}/{stage}").parquet(f"{self.out}/{stage}").join(own, ["sheet_id", "run"], "left_semi").drop("run")

    def failed(self) -> DataFrame:
        """(sheet_id, stage, error) of the sheets that a stage could not do."""
        return self.manifest().where("error is not null").select("sheet_id", "stage", "error")

    def run(self, stage: str, inputs: dict[str, DataFrame], compute: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
        """The stage's results for all sheets of the inputs, computing those only that the manifest lacks.

        compute's rows have sheet_id and may have `error`: a sheet with an error is entered as failed and gives no rows.
        """
        marks = fingerprints(inputs).withColumn("stage", F.lit(stage))
        todo = marks.join(self.manifest().select("sheet_id", "stage", "input"), ["sheet_id", "stage", "input"], "left_anti")
        run = uuid.uuid4().hex
        path = f"{self.out}/todo/{stage}/{run}"
        todo.write.parquet(path)
        todo = self.spark.read.schema(marks.schema).parquet(path)
        if not todo.isEmpty():
            own = {name: df.join(todo.select("sheet_id"), "sheet_id", "left_semi") for name, df in inputs.items()}
            made, at = compute(own), f"{self.out}/{stage}/run={run}"
            wrong = F.col("error") if "error" in made.columns else F.lit(None).cast("string")
            made.withColumn("error", wrong).write.parquet(at)
            bad = self.spark.read.parquet(at).where("error is not null").groupBy("sheet_id").agg(F.min("error").alias("error"))
            entry = todo.join(bad, "sheet_id", "left").select("sheet_id", "stage", "input", F.lit(run).alias("run"), "error")
            entry.withColumn("at", (F.unix_micros(F.current_timestamp()))).write.mode("append").parquet(f"{self.out}/manifest")
        return self.results(stage).drop("error") if exists(self.spark, f"{self.out}/{stage}") else compute(inputs).limit(0)


def guarded(each: Callable[[pd.Series], list[dict]], schema: str) -> r.Stage:
    """An image stage whose rows have `error`: what goes wrong with an image becomes a row of its own, without the other columns."""

    def safe(row: pd.Series) -> list[dict]:
        try:
            return [found | {"error": None} for found in each(row)]
        except Exception as e:  # noqa: BLE001  any fault of one sheet is told, not raised
            names = [c.strip().split()[0] for c in schema.split(",")]
            return [dict.fromkeys(names) | {"sheet_id": row["sheet_id"], "error": f"{type(e).__name__}: {e}"}]

    return r.image_stage(safe, f"{schema}, error string")


def strokes_of_files(files: DataFrame, least: float = 12.0, slope: float = 0.1, threshold: int = 240) -> DataFrame:
    """Segments (sheet_id, line_ix, axis, pos, lo, hi, dashed, error) of image files (sheet_id, content) whose strokes run near an axis."""
    from sheetgraph.sources import png

    def each(row: pd.Series) -> list[dict]:
        shown = png.decode(bytes(row["content"]) if row["content"] is not None else b"")
        mask = r.ink(shown if shown.ndim == 2 else r.gray(shown), threshold)
        out = []
        for x1, y1, x2, y2 in r.segments(r.thinned(mask), least=int(least)):
            wide, high = abs(x2 - x1), abs(y2 - y1)
            if min(wide, high) <= slope * max(wide, high):
                h = wide >= high
                pos, ends = ((y1 + y2) / 2, (x1, x2)) if h else ((x1 + x2) / 2, (y1, y2))
                out.append({"axis": "h" if h else "v", "pos": float(np.rint(pos)), "lo": min(ends), "hi": max(ends)})
        out.sort(key=lambda s: (s["axis"], s["pos"], s["lo"]))
        return [{"sheet_id": row["sheet_id"], "line_ix": k, **s, "dashed": False} for k, s in enumerate(out)]

    return guarded(each, "sheet_id long, line_ix long, axis string, pos double, lo double, hi double, dashed boolean")(files)


def sheets(spark: SparkSession, files: DataFrame, symbols: DataFrame, texts: DataFrame, out: str, upto: str | None = None) -> Job:
    """From image files (sheet_id, content), symbols and texts to strokes, and to one nested crossing graph a sheet, stored as rows and as viewer JSON under `out`/viewer.

    `upto` ends the job after that stage; the same call without it goes on from there.
    """
    todo = Job(spark, out)
    strokes = todo.run("strokes", {"files": files}, lambda own: strokes_of_files(own["files"]))
    if upto == "strokes":
        return todo
    empty = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind)).alias(c)
    kinds = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], job.GRAPH).schema}
    graph = todo.run("graph", {"strokes": strokes, "symbols": symbols, "texts": texts}, lambda own: job.nested(job.crossing_graph(own["strokes"], own["symbols"], own["texts"])).select("sheet_id", *[empty(c, kinds[c]) for c in ("runs", "points", "edges", "links")]))
    if upto == "graph":
        return todo
    p.write_json(graph.orderBy("sheet_id"), f"{out}/viewer")
    return todo


@query("s17_resumed_job", f"{_RUNS} select sheet_id, axis, run_id, lo, hi, round(pos, 6) as pos, dashed from runs")
def s17_resumed(spark, sf):
    """Runs of all sheets from a job that was first given every other sheet, as if cut off, and then all of them."""
    pieces = fragments(spark, sf)
    stitch = lambda own: x.runs_of(x.fragment_groups(own["fragments"], job.KEY, 2.5, 25.0, "line_ix"), job.KEY)
    todo = Job(spark, job._folder(spark, "resumed"))
    todo.run("runs", {"fragments": pieces.where("sheet_id % 2 = 0")}, stitch)
    return todo.run("runs", {"fragments": pieces}, stitch).select("sheet_id", "axis", "run_id", "lo", "hi", F.round("pos", 6).alias("pos"), "dashed")
