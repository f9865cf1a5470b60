"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Each text has four SimHash fingerprints (256 bits) over its distinct shingles. Two texts meet
when they agree in all bits of one of `tables` samples of fingerprint bits; the samples'
width grows with log n, and their number follows from the recall at the threshold. Pairs that
meet and differ in at most radii()[0] of the first 128 bits, told by the bit planes and carry-save
counters of the SimHash operator, propose groups, of which only a spanning forest leaves a block. Inside a group, block by block, the sets themselves decide, so
every link is true; a pair is not compared when other links of its block join it already.

Edge cases: a text of fewer than `words` words has its whole sequence as one shingle; all
texts without words are one class, nulls included; a row with a null doc_id stays only if no
row of its class has an id; of repeated rows one stays; an empty table gives an empty result;
other columns are kept, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sheetgraph.llm.blocks import block_tasks, deal
from sheetgraph.llm.common import drop_stash, split_batches, stash, text_bytes
from sheetgraph.llm.simhash import close_pairs, forest
from sheetgraph.operators.components import connected_components

#: How many deviations above their mean the differing bits of a pair at the threshold may lie, of 128 bits (when groups are proposed) and of 256 (before sets are compared).
SLACK, WIDE_SLACK = 3.6, 5.7
#: Rows that are compared at once; a larger group is searched from member to member.
BLOCK = 256
SIGNS = ["s0", "s1", "s2", "s3"]


def shingles(text: bytes, words: int = 5) -> np.ndarray:
    """The sorted distinct XXH64 (seed 42) of the text's shingles; empty for a text without words."""
    import xxhash

    parts = text.lower().split()
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(b" ".join(parts), 42)] if parts else [], np.uint64)
    return np.unique(np.array([digest(b" ".join(parts[k : k + words]), 42) for k in range(len(parts) - words + 1)], np.uint64))


def signature(items: np.ndarray) -> np.ndarray:
    """Four 64-bit SimHashes of a set."""
    ones = np.zeros(256, np.int64)
    for at in range(0, len(items), 1 << 12):
        h = items[at : at + (1 << 12), None] + np.arange(1, 5, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        ones += np.unpackbits(h.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(items)).view(np.uint64)


def differing(similarity: float) -> float:
    """The probability that a fingerprint bit of two sets of that Jaccard similarity differs."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def radii(similarity: float = 0.8) -> tuple[int, int]:
    """The most differing bits of 128 and of 256 that a pair at the threshold shows, but for one in thousands and in millions (0.8: 34 and 72)."""
    p = differing(similarity)
    return tuple(math.ceil(n * p + slack * math.sqrt(n * p * (1 - p))) for n, slack in ((128, SLACK), (256, WIDE_SLACK)))


def samples(n: int, similarity: float = 0.8, recall: float = 0.995) -> np.ndarray:
    """Rows of bit numbers: as many samples as find a pair at the threshold with that probability, wide enough for n texts."""
    width = max(8, math.ceil(math.log2(max(n, 2))) - 4)
    differ = differing(similarity)
    far = np.arange(257)
    weight = np.array([math.comb(256, int(k)) * differ**k * (1 - differ) ** (256 - k) for k in far])
    meet = np.array([math.comb(256 - int(k), width) / math.comb(256, width) for k in far])
    tables = next((t for t in range(1, 1 << 12) if (weight * (1 - (1 - meet) ** t)).sum() >= recall), None)
    if tables is None:
        raise ValueError(f"pairs of similarity {similarity} among {n} texts need more than {(1 << 12) - 1} tables")
    rng = np.random.default_rng(5)
    return np.stack([rng.choice(256, width, replace=False) for _ in range(tables)])


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of rows of words."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def spread(signs: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links of a spanning forest over the rows within the radius of each other."""
    left, a, b = np.arange(len(signs)), [], []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            u = queue.pop()
            near = distance(signs[left], signs[u]) <= radius
            found = left[near].tolist()
            left = left[~near]
            a += [u] * len(found)
            b += found
            queue += found
    return a, b


def proposed(nodes: DataFrame, bits: np.ndarray, radius: int) -> DataFrame:
    """Edges (a, b) that connect all nodes that meet within the radius; b is the least of its links in the block, so the tables repeat edges."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = 1 << np.arange(bits.shape[1], dtype=np.int64)
        for batch in split_batches(batches, 2048):
            node, *s = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("node", *SIGNS)]
            flat = np.unpackbits(np.ascontiguousarray(np.stack(s, axis=1)).view(np.uint8), axis=1)
            for t, row in enumerate(bits):
                code = flat[:, row].astype(np.int64) @ power + (t << 48)
                yield pa.RecordBatch.from_pydict({"k": pa.array(code), "node": pa.array(node), "s0": pa.array(s[0]), "s1": pa.array(s[1])})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 4), np.int64)
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("k", "node", "s0", "s1")], axis=1)
            held = np.concatenate([held, rows])
            done = int(np.searchsorted(held[:, 0], held[-1, 0])) if len(held) else 0
            if done:
                yield blocks(held[:done])
                held = held[done:]
        if len(held):
            yield blocks(held)

    def blocks(rows: np.ndarray) -> pa.RecordBatch:
        signs = np.ascontiguousarray(rows[:, 2:]).view(np.uint64)
        edge = np.concatenate([[0], np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1, [len(rows)]])
        size = np.diff(edge)
        i, j = [], []
        for lo, hi in zip(edge[:-1][size > BLOCK].tolist(), edge[1:][size > BLOCK].tolist(), strict=True):
            a, b = spread(signs[lo:hi], radius)
            i.append(np.array(a, np.int64) + lo)
            j.append(np.array(b, np.int64) + lo)
        # small groups are compared together, bit plane by bit plane: what is near in two of them is near as well
        small = np.flatnonzero(np.repeat((size > 1) & (size <= BLOCK), size))
        group = np.repeat(np.arange(len(size)), size)[small]
        start = 0
        while start < len(small):
            stop = min(start + BLOCK, len(small))
            if stop < len(small) and group[stop] == group[stop - 1]:
                stop = int(np.searchsorted(group, group[stop - 1]))
            a, b = close_pairs(signs[small[start:stop]], None, radius)
            i.append(small[start + a])
            j.append(small[start + b])
            start = stop
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (i, j))
        low = forest(len(rows), i, j)
        k = np.flatnonzero(low != np.arange(len(rows)))
        return pa.RecordBatch.from_pydict({"a": pa.array(rows[k, 1]), "b": pa.array(rows[low[k], 1])})

    keyed = nodes.where("size > 0").select("node", *SIGNS).mapInArrow(key, "k long, node long, s0 long, s1 long")
    met = keyed.repartition("k").sortWithinPartitions("k", "node").mapInArrow(meet, "a long, b long")

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A node's links (its b in order) as links to the least: each table has found much the same ones."""
        now, low, seen = None, None, set()
        for batch in batches:
            out = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                if a != now:
                    now, low = a, b
                    out.append((a, b))
                elif b != low and (b, low) not in seen:
                    seen.add((b, low))
                    out.append((b, low))
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    return met.repartition("a").sortWithinPartitions("a", "b").mapInArrow(least, "a long, b long")


def classes(sets: list[np.ndarray], similarity: float = 0.8, side: np.ndarray | None = None) -> np.ndarray:
    """For each set the least index that it reaches over pairs of at least that similarity; with `side`, over pairs of different sides."""
    wide = radii(similarity)[1]
    root, size, signs = np.arange(len(sets)), np.array([len(s) for s in sets]), np.stack([signature(s) for s in sets])
    for i in range(1, len(sets)):
        small, large = np.minimum(size[:i], size[i]), np.maximum(size[:i], size[i])
        may = (small >= similarity * large) & (distance(signs[:i], signs[i]) <= wide)
        ask = np.flatnonzero(may if side is None else may & (side[:i] != side[i]))
        while len(ask := ask[root[ask] != root[i]]):
            j, ask = int(ask[0]), ask[1:]
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both >= similarity * (size[i] + size[j] - both):
                lo, hi = sorted((int(root[i]), int(root[j])))
                root[root == hi] = lo
    return root


def verified(members: DataFrame, words: int, similarity: float, most: int = 512) -> DataFrame:
    """Links (a, b) that connect all texts of a proposed group that are near copies.

    A group of over `most` texts is cut into chunks that meet in pairs, so no task holds a whole
    large group; a block leaves the spanning forest of its own true links.
    """
    keys = ["component", "_i", "_j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sets, side = None, [], [], []

        def flush() -> pa.RecordBatch:
            root = classes(sets, similarity, np.array(side) if now[1] != now[2] else None)
            k = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_pydict({"a": pa.array([ids[x] for x in k], pa.int64()), "b": pa.array([ids[x] for x in root[k]], pa.int64())})

        for b in split_batches(batches, 256):
            for *block, first, node, text in zip(*(b.column(c).to_pylist() for c in (*keys, "_first", "node")), text_bytes(b.column("text")), strict=True):
                if block != now:
                    if len(ids) > 1:
                        yield flush()
                    now, ids, sets, side = block, [], [], []
                ids.append(node)
                sets.append(shingles(text, words))
                side.append(first)
        if len(ids) > 1:
            yield flush()

    return block_tasks(deal(members, ["component"], "node", most), ["component"]).select(*keys, "_first", "node", "text").mapInArrow(run, "a long, b long")


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with one row of each class of near copies: that of the least doc_id, then of the least hash of its text.

    A similarity far below 0.8 takes many tables; where 4095 don't reach the planned recall, that is an error.
    The row itself travels as one column, so no name of docs can clash with those used here.
    """
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    schema = StructType([*own.schema.fields, *[StructField(c, LongType()) for c in ("node", "size", *SIGNS)]])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in split_batches(batches, 512):
            sets = [shingles(t, words) for t in text_bytes(pc.struct_field(b.column("d"), "text"))]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes(), 42) for s in sets], np.uint64).view(np.int64)
            signs = np.stack([signature(s) for s in sets]).view(np.int64)
            more = [node, np.array([len(s) for s in sets], np.int64), *signs.T]
            yield pa.RecordBatch.from_arrays([b.column("d"), *[pa.array(np.ascontiguousarray(x)) for x in more]], names=schema.fieldNames())

    marked = stash(own.mapInArrow(mark, schema).withColumn("row", F.monotonically_increasing_id()), "marked")
    best = F.struct(F.col("d.doc_id").isNull().alias("nameless"), F.col("d.doc_id").cast("long").alias("id"), F.xxhash64("d.text").alias("hash"), F.col("row").alias("row"))
    nodes = stash(marked.groupBy("node").agg(F.min(best).alias("best"), *[F.first(c).alias(c) for c in ("size", *SIGNS)]), "nodes")
    edges = proposed(nodes, samples(nodes.count(), similarity), radii(similarity)[0])
    groups = stash(connected_components(edges), "groups")
    members = nodes.join(groups, "node").select(F.col("best.row").alias("row"), "node", "component")
    texts = stash(marked.select("row", F.col("d.text").alias("text")).join(members, "row").select("component", "node", "text"), "members")
    found = stash(connected_components(verified(texts, words, similarity)), "verified")
    for done in (groups, texts):
        drop_stash(done)
    kept = nodes.join(found, "node", "left").groupBy(F.coalesce("component", "node")).agg(F.min("best").alias("b")).select(F.col("b.row").alias("row"))
    return marked.join(kept, "row", "left_semi").select("d.*")
