"""Sharding by weighted rendezvous hashing of stable record keys.

Each shard gets a score from the key and its own number; the record goes to the best score.
A new shard takes records only into itself, since no other score changes. Only built-in
functions are used; slots are numbered by counting salted buckets first, so that no task
holds a shard and no task holds a hot key.

Edge cases: a null key counts as one key of its own; equal keys always share a shard; repeated
rows keep a slot each; an empty table gives an empty result; other columns are kept,
but shard, grown_shard and slot are replaced (names with two leading underscores are reserved).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetgraph.llm.common import stash


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard for a key (text): the least -ln(u) / weight, u from 52 hash bits of key and shard."""
    costs = []
    for s, w in enumerate(weights):
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(s)), 12).cast("double") + 0.5) / float(1 << 52)
        costs.append(F.struct((-F.log(u) / float(w)).alias("cost"), F.lit(s).alias("shard")))
    return F.array_min(F.array(*costs))["shard"] if len(costs) > 1 else F.lit(0)


def assign(df: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] | None = None) -> DataFrame:
    """df with `shard`, and with `grown_shard` under the weights `grown` if given."""
    text = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("null"))
    out = df.withColumn("shard", shard_of(text, weights))
    return out.withColumn("grown_shard", shard_of(text, grown)) if grown else out


def number(df: DataFrame, key: str, buckets: int = 2048) -> DataFrame:
    """df, which has `shard`, with `slot`: gapless from 0 within each shard.

    Rows are dealt to `buckets` buckets a shard by key and place in the input, so that even one
    hot key is spread; a table of shards x buckets counts, of bounded size, gives each bucket's first slot.
    """
    rows = stash(df.withColumn("__row", F.monotonically_increasing_id()).withColumn("__bucket", F.pmod(F.xxhash64(F.col(key), "__row"), F.lit(buckets)).cast("int")), "slots")
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.groupBy("shard", "__bucket").agg(F.count("*").alias("__n")).select("shard", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    within = Window.partitionBy("shard", "__bucket").orderBy(key, "__row")
    return rows.withColumn("__k", F.row_number().over(within) - 1).join(first, ["shard", "__bucket"]).withColumn("slot", (F.col("__first") + F.col("__k")).cast("long")).drop("__row", "__bucket", "__k", "__first")
