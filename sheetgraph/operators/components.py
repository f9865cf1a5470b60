"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetgraph.plans.stages import drop_stash, stash


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges(a, b); component is the smallest node reachable.

    Alternates the large-star and small-star steps (Kiveris et al., 2014): each step only
    links nodes to the smallest node of their neighbourhood, so edges never grow beyond
    their first number and O(log n) rounds suffice in practice. Each round is written to
    the shared folder. Edges with a null end are ignored, loops name a node without links.
    Nodes may be of any type that can be ordered, structs included.
    """
    e = edges.select("a", "b").where("a is not null and b is not null")
    e = stash(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    first, before = e, None
    for _ in range(max_rounds):
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
        both = e.where("u <> v").select("u", "v").union(e.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m, "u").select(F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        nxt = stash(small, "cc")
        if e is not first:
            drop_stash(e)
        e = nxt
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = first.select(F.col("u").alias("node")).union(first.select(F.col("v").alias("node"))).distinct()
    return nodes.join(e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")), "node", "left").select("node", F.coalesce("m", "node").alias("component"))
