"""Dealing the members of buckets to blocks of bounded size, without losing a pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetgraph.llm.common import stash


def deal(keyed: DataFrame, key: list[str], item: str, most: int, small: int = 200_000) -> DataFrame:
    """keyed's rows with the block (i, j) and whether the row is of its first side.

    A bucket of up to `most` rows is the block (0, 0). A larger one is cut into chunks by a
    hash of `item`; chunk i meets chunk j in block (i, j), i <= j, so every pair of the bucket
    meets in exactly one block, no block holds over two chunks, and blocks are spread over tasks.
    The sizes of the large buckets are broadcast while there are at most `small` of them, so the
    rows move once, when they are cut; more are joined.
    """
    large = stash(keyed.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > most), "large")
    rows = keyed.join(F.broadcast(large) if large.count() <= small else large, key, "left").withColumn("_chunks", F.coalesce(F.ceil(F.col("_n") / most).cast("int"), F.lit(1)))
    rows = rows.withColumn("_c", F.pmod(F.xxhash64(F.col(item), F.lit(7)), F.col("_chunks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("_chunks") - 1), lambda k: F.struct(F.least("_c", k).alias("i"), F.greatest("_c", k).alias("j")))
    return rows.withColumn("_b", F.explode(F.when(F.col("_chunks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(meets))).select(*keyed.columns, F.col("_b.i").alias("_i"), F.col("_b.j").alias("_j"), (F.col("_c") == F.col("_b.i")).alias("_first"))


def block_tasks(dealt: DataFrame, key: list[str]) -> DataFrame:
    """The rows of a block, one after another, in one task."""
    parts = [*key, "_i", "_j"]
    return dealt.repartition(*parts).sortWithinPartitions(*parts)
