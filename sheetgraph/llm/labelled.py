"""The bounded sample of labelled rows that the two classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, most: int, longest: int = 1_000_000) -> DataFrame:
    """_id, text and y of up to `most` labelled documents of each class that are not held out.

    The rows are those with the least hash of their id, so the sample is the same in each run.
    At most 2 x most ids and labels are broadcast, so the texts are filtered where they are read.
    A document with several labels takes the largest; null labels and ids are left out. An id
    with several texts takes the one of the least hash, and texts of over `longest` bytes are not
    learned from, so the sample is bounded in rows and in bytes.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.max(label) > 0).cast("int").alias("y"))
    known = known.where(~held_out)
    picked = known.where("y = 1").orderBy(F.xxhash64("_id"), "_id").limit(most).union(known.where("y = 0").orderBy(F.xxhash64("_id"), "_id").limit(most))
    rows = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest).select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(picked), "_id")
    return rows.groupBy("_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "y")).alias("r")).select("_id", "r.text", "r.y")
