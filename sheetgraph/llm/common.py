"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetgraph.plans.stages import drop_stash, stash

__all__ = ["drop_stash", "fold", "keep_where", "split_batches", "stash", "table", "text_bytes"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, modulus: int, remainder: int):
    """True for rows whose crc32(column as text) leaves that remainder; false for a null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus == remainder, F.lit(False))


def split_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of at most `rows` rows, so that Python objects of only that many rows live at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def keep_where(docs: DataFrame, judge: Callable[[], Callable[[pa.Array], "object"]], column: str = "text") -> DataFrame:
    """docs, with all its columns, without the rows that judge()'s function of a batch's `column` calls false.

    judge is called once per task, so that what it builds is built on the executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good = judge()
        for b in split_batches(batches):
            yield b.filter(pa.array(good(b.column(column)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
