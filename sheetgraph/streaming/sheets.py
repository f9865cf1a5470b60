"""Sheets as they arrive: each is independent, so a stream needs no state and no watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sheetgraph.sources.payload import DETECTIONS


def read_stream(spark: SparkSession, path: str, schema: str = DETECTIONS, files_per_trigger: int = 1000) -> DataFrame:
    """Payload files, one row each, as they appear below path."""
    stem = F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]*)?$", 1)
    return spark.readStream.schema(schema).option("multiLine", True).option("maxFilesPerTrigger", files_per_trigger).json(path).withColumn("sheet_id", stem)


def run_stream(sheets: DataFrame, job: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Apply a batch job to each batch of sheets and store it below `out`, in a folder of the batch's number.

    A batch that is repeated after a failure replaces its own folder, so results appear once.
    """

    def each(batch: DataFrame, number: int) -> None:
        job(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return sheets.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
