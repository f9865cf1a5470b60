"""Hard negatives by exact inner products, with early discarding in a rotated frame.

All vectors are turned by one orthogonal matrix (the principal axes of a bounded sample, so that
leading components carry most of a product). An anchor's product with a row is summed over growing
numbers of leading components; what is left out is at most the product of the two residual norms, plus
slack for rounding. Pairs that can't be among the results any more are discarded, the others' products
are computed again in integers. The rotation only speeds the search: results are exact for any sample.

Rows are dealt to blocks of bounded size and stay there; anchors are sent to every block and stream
through it in small batches, so a task holds one block whatever the number of anchors. Two such passes
are made: for the positives of each anchor, then for its negatives in the score window of each positive.
Blocks return their best few, which a window per anchor merges. Work grows with rows times anchors.

Rows take no part if their id, label or vector is null, a component is null or not finite, or the squared
norm of their whole numbers reaches 2^56 (scores, times a hundred, would not fit 64 bits); zero and empty vectors do. An
id that occurs more than once counts once, with its least label and vector. Vectors meet those of
equal length only. Equal scores go by id. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetgraph.llm.common import drop_stash, stash
from sheetgraph.llm.vectors import matrix

#: A block's rows and the anchors of a batch, at most.
BLOCK, BATCH = 65_536, 64
#: Leading components that products are summed over before each discarding.
STEPS = (8, 16, 32)
_EPS = 2.0**-52


def numbered(rows: DataFrame, id_col: str, vector: str, label: Column, scale: int = 256) -> DataFrame:
    """(id, label, vec): one row an id, its vector in whole numbers floor(scale * x), as doubles."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.where(F.col(id_col).isNotNull() & label.isNotNull() & F.coalesce(fits, F.lit(False)))
    whole = F.transform(F.transform(vector, lambda x: x.cast("double") * scale), lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x))
    made = good.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("vec"))
    small = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x) < float(1 << 56)
    return made.where(small).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("v")).select("id", "v.label", "v.vec")


def rotation(points: DataFrame, sample: int = 4096) -> dict[int, np.ndarray]:
    """Principal axes, most important first, for each length of vectors among the `sample` rows of least hash."""
    held = [r.vec for r in points.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").collect()]
    turned = {}
    for d in {len(v) for v in held} - {0}:
        v = np.array([x for x in held if len(x) == d])
        turned[d] = np.ascontiguousarray(np.linalg.eigh(v.T @ v)[1][:, ::-1])
    return turned


class Frame:
    """Vectors (n x d, whole numbers) turned, with the norms of what is left from each component on."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray | None):
        self.whole = vectors.astype(np.int64)
        self.turned = vectors @ turn if turn is not None else vectors
        squares = np.cumsum((self.turned**2)[:, ::-1], axis=1)[:, ::-1]
        self.rest = np.sqrt(np.concatenate([squares, np.zeros((len(vectors), 1))], axis=1))

    def take(self, at: np.ndarray) -> "Frame":
        out = object.__new__(Frame)
        out.whole, out.turned, out.rest = self.whole[at], self.turned[at], self.rest[at]
        return out


def survivors(a: Frame, b: Frame, meets: np.ndarray, least: Callable[[np.ndarray, np.ndarray], np.ndarray], most: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of `meets` whose product may be at least least(lower bounds, upper bounds) of anchor i, and at most `most` of it."""
    d = a.turned.shape[1]
    steps = sorted({min(s, d) for s in STEPS} | {d})
    slack = 64 * (d + 8) * _EPS
    m = steps[0]
    part = a.turned[:, :m] @ b.turned[:, :m].T
    off = np.outer(a.rest[:, m], b.rest[:, m]) * (1 + 1e-9) + np.outer(a.rest[:, 0], b.rest[:, 0]) * slack
    low, high = np.where(meets, part - off, -np.inf), np.where(meets, part + off, -np.inf)
    limit = least(low, high)
    alive = meets & (high >= limit[:, None])
    if most is not None:
        alive &= low <= most[:, None]
    i, j = np.nonzero(alive)
    part = part[i, j]
    for of, m in zip(steps, steps[1:], strict=False):
        part = part + np.einsum("ij,ij->i", a.turned[i, of:m], b.turned[j, of:m])
        off = a.rest[i, m] * b.rest[j, m] * (1 + 1e-9) + a.rest[i, 0] * b.rest[j, 0] * slack
        alive = part + off >= limit[i]
        if most is not None:
            alive &= part - off <= most[i]
        i, j, part = i[alive], j[alive], part[alive]
    return i, j


def products(a: Frame, b: Frame, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The inner products of pairs, in integers."""
    return np.einsum("ij,ij->i", a.whole[i], b.whole[j])


def first(groups: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the first k of each group, by falling score and id."""
    by = np.lexsort((ids, -scores, groups))
    start = np.flatnonzero(np.r_[True, groups[by][1:] != groups[by][:-1]][: len(by)])
    return by[np.arange(len(by)) - np.repeat(start, np.diff(np.r_[start, len(by)])) < k]


def _kth(low: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, -inf where there are fewer."""
    return np.partition(low, -k, axis=1)[:, -k] if low.shape[1] >= k else np.full(len(low), -np.inf)


def label_mates(anchors: Frame, anchor_id: np.ndarray, anchor_label: np.ndarray, rows: Frame, ids: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of each anchor's first k other rows of its label, within a block."""
    found = [(np.zeros(0, np.int64),) * 3]
    for label in np.unique(anchor_label):
        at, own = np.flatnonzero(anchor_label == label), np.flatnonzero(labels == label)
        if len(own):
            a, b = anchors.take(at), rows.take(own)
            i, j = survivors(a, b, anchor_id[at][:, None] != ids[own][None, :], lambda low, high: _kth(low, k))
            score = products(a, b, i, j)
            keep = first(i, ids[own[j]], score, k)
            found.append((at[i[keep]], own[j[keep]], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def in_windows(anchors: Frame, anchor_label: np.ndarray, scores: list[list[int]], rows: Frame, ids: np.ndarray, labels: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, ...]:
    """(anchor, place of the positive, row, score): the first k rows of other labels with low * positive <= 100 * score <= high * positive, within a block."""
    ends = [(min(low * p / 100 for p in s), min(high * p / 100 for p in s), max(high * p / 100 for p in s)) for s in scores]
    bottom, lowest_top, top = (np.array(x) for x in zip(*ends, strict=True))
    width = 1e-9 * (1 + np.abs(bottom) + np.abs(top))

    def least(lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        """The lowest window's start, or what its k-th row surely reaches: rows below are in no window's first k."""
        return np.maximum(bottom - width, _kth(np.where(highs <= (lowest_top - width)[:, None], lows, -np.inf), k))

    i, j = survivors(anchors, rows, anchor_label[:, None] != labels[None, :], least, top + width)
    score = products(anchors, rows, i, j)
    found = [(np.zeros(0, np.int64),) * 4]
    for p in range(max(map(len, scores))):
        positive = np.array([s[p] if p < len(s) else 0 for s in scores], np.int64)[i]
        has = np.array([p < len(s) for s in scores])[i]
        at = np.flatnonzero(has & (low * positive <= 100 * score) & (100 * score <= high * positive))
        at = at[first(i[at], ids[j[at]], score[at], k)]
        found.append((i[at], np.full(len(at), p, np.int64), j[at], score[at]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _blocks(points: DataFrame, anchors: DataFrame, n: int) -> DataFrame:
    """Rows in n blocks, one a partition, and all anchors in each block after its rows."""
    rows = points.select(F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("block"), F.lit(0).alias("side"), "id", "label", "vec", F.lit(None).cast("array<long>").alias("scores"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"), F.lit(1).alias("side"), "id", "label", "vec", "scores")
    return rows.unionByName(asked).repartitionById(n, F.col("block")).sortWithinPartitions("block", "side")


def _search(turn: dict[int, np.ndarray], judge: Callable, batch: int = BATCH) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For a partition of _blocks: judge's results for each batch of anchors against the block's rows of their length."""

    def frames(t: pa.Table) -> dict[int, tuple]:
        vectors = t["vec"].combine_chunks()
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        out = {}
        for d in np.unique(sizes).tolist():
            at = pa.array(np.flatnonzero(sizes == d))
            own = matrix(vectors.take(at)) if d else np.zeros((len(at), 0))
            out[d] = (Frame(own, turn.get(d)), t["id"].take(at).to_numpy(), t["label"].take(at).to_numpy(), t["scores"].take(at).to_pylist())
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows: dict[int, tuple] | None = None
        for b in batches:
            cut = int(np.searchsorted(b.column("side").to_numpy(), 1))
            if cut:
                held.append(b.slice(0, cut))
            if cut < b.num_rows and rows is None:
                rows, held = frames(pa.Table.from_batches(held)) if held else {}, []
            for at in range(cut, b.num_rows, batch):
                for d, asked in frames(pa.Table.from_batches([b.slice(at, batch)])).items():
                    if d in rows:
                        yield judge(asked, rows[d])

    return run


def mine(rows: DataFrame, id_col: str, vector: str, label: Column, asked: Callable[[Column], Column], positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """Of each row that asked(id) picks: its first rows of the same label, and for each of those the first rows of
    other labels whose score is `low` to `high` hundredths of the positive's: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.
    """
    points = stash(numbered(rows, id_col, vector, label, scale), "points")
    n = points.count()
    turn = rotation(points)
    blocks = max(-(-n // BLOCK), min(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-n // 1024)), 1)
    anchors = points.where(asked(F.col("id")))

    def same(a: tuple, b: tuple) -> pa.RecordBatch:
        i, j, score = label_mates(a[0], a[1], a[2], b[0], b[1], b[2], positives)
        return pa.RecordBatch.from_pydict({"anchor_id": pa.array(a[1][i], pa.int64()), "positive_id": pa.array(b[1][j], pa.int64()), "score": pa.array(score, pa.int64())})

    def others(a: tuple, b: tuple) -> pa.RecordBatch:
        i, p, j, score = in_windows(a[0], a[2], a[3], b[0], b[1], b[2], negatives, low, high)
        return pa.RecordBatch.from_pydict({"anchor_id": pa.array(a[1][i], pa.int64()), "place": pa.array(p + 1, pa.int32()), "negative_id": pa.array(b[1][j], pa.int64()), "negative_score": pa.array(score, pa.int64())})

    near = _blocks(points, anchors.withColumn("scores", F.lit(None).cast("array<long>")), blocks).mapInArrow(_search(turn, same), "anchor_id long, positive_id long, score long")
    order = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "positive_id")
    mates = stash(near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives), "mates")
    windows = mates.groupBy(F.col("anchor_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda x: x["score"]).alias("scores"))
    found = _blocks(points, anchors.join(windows, "id"), blocks).mapInArrow(_search(turn, others), "anchor_id long, place int, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    out = stash(best.join(mates.select("anchor_id", "place", "positive_id", F.col("score").alias("positive_score")), ["anchor_id", "place"]), "negatives")
    drop_stash(points)
    drop_stash(mates)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
