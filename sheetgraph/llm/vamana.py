"""Approximate nearest neighbours with a robust-pruned directed graph per shard.

Exact copies are one point. Points are dealt to shards by a hash of their id; in each shard a
graph is built: greedy searches from the entry point propose neighbours, and relaxed distance
pruning keeps those that no kept neighbour makes redundant; points that no walk reaches then
get an edge of their own. Each block of queries is searched in each shard with a beam, many
queries at a time, and the best of all shards are kept. The search works on vectors centred
and scaled for each shard; distances that reach the result are computed in double precision
from the original vectors.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components take no
part; a query gets no neighbour of another length; ties go to the smaller id; of a class of
copies only as many members as can be in a result are expanded; repeated ids are separate
rows; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetgraph.llm.common import stash
from sheetgraph.llm.vectors import matrix, plain, usable


class Frame:
    """How a shard's vectors are moved and scaled, in double precision, before the search.

    The centre is the median of each component, so a few far points do not hide the others; the
    unit is the largest distance of a component from it. Single precision is used only where its
    rounding is far below the distances between neighbours (of a sample of points), else double.
    """

    def __init__(self, x: np.ndarray, sample: int = 64):
        self.most = float(np.abs(x).max(initial=0)) or 1.0
        self.centre = np.median(x / self.most, axis=0) if len(x) else np.zeros(x.shape[1])
        self.unit, self.kind = 1.0, np.float64
        z = self(x)
        self.unit = float(np.abs(z).max(initial=0)) or 1.0
        z /= self.unit
        own = np.random.default_rng(len(x)).permutation(len(x))[:sample]
        near = np.concatenate([_gaps(z, z[k : k + 1]) for k in own]) if len(x) else np.zeros((0, 0))
        near = np.where(near > 0, near, np.inf).min(axis=1, initial=np.inf)
        near = near[np.isfinite(near)]
        if not len(near) or np.quantile(near, 0.05) > 1e-10:
            self.kind = np.float32

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """x in this frame; a vector too far out to be squared there is drawn in along its line."""
        far, most = (1e15 if self.kind is np.float32 else 1e140), max(self.most, 1e-300)
        with np.errstate(over="ignore"):
            z = np.clip(x / most, -1e300, 1e300)
            z = np.clip((z - self.centre) / self.unit, -1e300, 1e300)
        out = np.abs(z).max(axis=1, keepdims=True, initial=0)
        return np.where(out > far, z / np.maximum(out / far, 1), z).astype(self.kind)


def _gaps(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of each row of q to all rows of x."""
    return np.stack([np.einsum("ij,ij->i", d, d) for d in (x - y for y in q)])


def euclidean(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances along the last axis; squares that would leave double precision's range are scaled."""
    with np.errstate(over="ignore", invalid="ignore"):
        d = x - y
        most = np.abs(d).max(axis=-1, initial=0)
        out = np.sqrt((d * d).sum(axis=-1))
        odd = (most > 1e150) | ((most < 1e-150) & (most > 0))
        if odd.any():
            half = np.ldexp(x[odd], -2) - np.ldexp(np.broadcast_to(y, x.shape)[odd], -2)
            top = np.abs(half).max(axis=-1, keepdims=True)
            out[odd] = 4 * top[..., 0] * np.sqrt(((half / np.maximum(top, 5e-324)) ** 2).sum(axis=-1))
    return out


class Graph:
    """A directed graph over the rows of `points`, each within reach of the entry."""

    def __init__(self, points: np.ndarray, degree: int = 32, beam: int = 64, relax: float = 1.2, batch: int = 512, seed: int = 5):
        self.frame = Frame(points)
        self.points = np.ascontiguousarray(self.frame(points))
        n = len(points)
        self.degree = min(degree, max(1, n - 1))
        self.relax2 = relax * relax
        self.entry = int(np.argmin(np.einsum("ij,ij->i", self.points, self.points))) if n else 0
        rng = np.random.default_rng([seed, n])
        self.edges = np.full((n, self.degree), -1, np.int32)
        if n < 2:
            return
        start = rng.integers(0, n - 1, (n, min(self.degree, 12)))
        self.edges[:, : start.shape[1]] = start + (start >= np.arange(n)[:, None])
        for _ in range(2):
            order = rng.permutation(n)
            for lo in range(0, n, batch):
                own = order[lo : lo + batch]
                found, _, seen = self.search(self.points[own], beam, trace=True)
                self._link(own, np.concatenate([seen, found, self.edges[own]], axis=1))
        self._bridge(beam)

    def _bridge(self, beam: int) -> None:
        """One more edge a point, from the nearest reached point that has none yet to one that no walk from the entry reaches."""
        n = len(self.points)
        self.edges = np.concatenate([self.edges, np.full((n, 1), -1, np.int32)], axis=1)
        reached = np.zeros(n, bool)

        def walk(at: np.ndarray) -> None:
            while len(at):
                reached[at] = True
                to = np.unique(self.edges[at])
                to = to[to >= 0]
                at = to[~reached[to]]

        walk(np.array([self.entry]))
        for u in range(n):
            if not reached[u]:
                found, _, _ = self.search(self.points[u : u + 1], beam)
                free = [v for v in found[0].tolist() if v >= 0 and self.edges[v, -1] < 0]
                if not free:
                    free = [int(x) for x in np.flatnonzero(reached & (self.edges[:, -1] < 0))]
                    free = [free[int(np.argmin(_gaps(self.points[free], self.points[u : u + 1])[0]))]]
                self.edges[free[0], -1] = u
                walk(np.array([u]))

    def _distances(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its row of candidates; those below 0 are missing. Differences are taken first: nothing cancels."""
        d = self.points[rows]
        d -= q[:, None, :]
        return np.where(rows < 0, np.inf, np.einsum("ijk,ijk->ij", d, d))

    def search(self, q: np.ndarray, beam: int, wide: int = 4, trace: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, squared distances) of each query's beam, nearest first, -1 where it is short, and the rows expanded if traced.

        q is in the graph's frame.
        """
        n = len(q)
        rows = np.full((n, beam), -1, np.int32)
        rows[:, 0] = self.entry
        dist = np.full((n, beam), np.inf, self.points.dtype)
        dist[:, 0] = self._distances(rows[:, :1], q)[:, 0]
        done = np.zeros((n, beam), bool)
        met = np.zeros((n, len(self.points)), bool)
        met[:, self.entry] = True
        live = np.arange(n)
        seen: list[np.ndarray] = []
        while len(live):
            open_ = np.where(done[live] | (rows[live] < 0), np.inf, dist[live])
            pick = np.argpartition(open_, min(wide, beam - 1), axis=1)[:, :wide] if beam > wide else np.argsort(open_, axis=1)
            valid = np.isfinite(np.take_along_axis(open_, pick, axis=1))
            go = valid.any(axis=1)
            live, pick, valid = live[go], pick[go], valid[go]
            if not len(live):
                break
            at = np.where(valid, np.take_along_axis(rows[live], pick, axis=1), -1)
            d_ = done[live]
            np.put_along_axis(d_, pick, np.take_along_axis(d_, pick, axis=1) | valid, axis=1)
            done[live] = d_
            if trace:
                full = np.full((n, at.shape[1]), -1, np.int32)
                full[live] = at
                seen.append(full)
            new = np.where(at[:, :, None] < 0, -1, self.edges[np.maximum(at, 0)]).reshape(len(live), -1)
            new[met[live[:, None], new] & (new >= 0)] = -1
            new = np.sort(new, axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            r, c = np.nonzero(new >= 0)
            met[live[r], new[r, c]] = True
            every = np.concatenate([rows[live], new], axis=1)
            d = np.concatenate([dist[live], self._distances(new, q[live])], axis=1)
            flag = np.concatenate([done[live], np.zeros(new.shape, bool)], axis=1)
            best = np.argpartition(d, beam - 1, axis=1)[:, :beam]
            rows[live], dist[live], done[live] = (np.take_along_axis(x, best, axis=1) for x in (every, d, flag))
        order = np.argsort(dist, axis=1, kind="stable")
        rows = np.where(np.isinf(np.take_along_axis(dist, order, axis=1)), -1, np.take_along_axis(rows, order, axis=1))
        return rows, np.take_along_axis(dist, order, axis=1), np.concatenate(seen, axis=1) if trace else rows

    def _prune(self, own: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Up to `degree` neighbours of each of `own`: the nearest candidate stays and removes those it is relaxed-closer to."""
        candidates = np.where(candidates == own[:, None], -1, candidates)
        candidates = np.sort(candidates, axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        q = self.points[own]
        d = self._distances(candidates, q)
        width = min(candidates.shape[1], 3 * self.degree)
        order = np.argsort(d, axis=1)[:, :width]
        candidates, d = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(d, order, axis=1)
        x = self.points[candidates] - q[:, None, :]  # seen from their own point, near candidates have small norms
        norm = np.einsum("ijk,ijk->ij", x, x)
        between = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
        alive = np.isfinite(d)
        out = np.full((len(own), self.degree), -1, np.int32)
        line = np.arange(len(own))
        for k in range(self.degree):
            some = alive.any(axis=1)
            if not some.any():
                break
            first = np.argmax(alive, axis=1)
            out[:, k] = np.where(some, candidates[line, first], -1)
            alive &= self.relax2 * between[line, first] > d
            alive[line, first] = False
        return out

    def _link(self, own: np.ndarray, candidates: np.ndarray) -> None:
        self.edges[own] = self._prune(own, candidates)
        src = np.repeat(own, self.degree)
        dst = self.edges[own].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        fresh = ~(self.edges[dst] == src[:, None]).any(axis=1)
        src, dst = src[fresh], dst[fresh]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        to, first, count = np.unique(dst, return_index=True, return_counts=True)
        back = np.full((len(to), int(count.max(initial=0))), -1, np.int32)
        back[np.repeat(np.arange(len(to)), count), np.arange(len(dst)) - np.repeat(first, count)] = src
        used = (self.edges[to] >= 0).sum(axis=1)
        room = used + count <= self.degree
        for k in np.flatnonzero(room).tolist():
            self.edges[to[k], used[k] : used[k] + count[k]] = back[k, : count[k]]
        full = np.flatnonzero(~room)
        if len(full):
            self.edges[to[full]] = self._prune(to[full], np.concatenate([self.edges[to[full]], back[full]], axis=1))


SHARD = "dim int, shard int, ids binary, points binary, entry int, edges binary"


def build(distinct: DataFrame, shards: int, degree: int, beam: int) -> DataFrame:
    """One row per shard and length of vector: the ids, the points and the graph."""

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        x = np.array(rows["vec"].tolist(), np.float64)
        g = Graph(x, degree, beam)
        return pd.DataFrame({"dim": [x.shape[1]], "shard": [int(key[1])], "ids": [rows["id"].to_numpy(np.int64).tobytes()], "points": [x.tobytes()], "entry": [g.entry], "edges": [g.edges.tobytes()]})

    dealt = distinct.select("id", "vec", F.size("vec").alias("dim"), F.pmod(F.xxhash64("id", F.lit(3)), F.lit(shards)).cast("int").alias("shard"))
    return dealt.repartition(4 * shards, "dim", "shard").groupBy("dim", "shard").applyInPandas(one, SHARD)  # few bytes, much work: as many partitions as that asks for


def _load(ids: bytes, points: bytes, entry: int, edges: bytes) -> tuple[np.ndarray, np.ndarray, Graph]:
    own = np.frombuffer(ids, np.int64)
    x = np.frombuffer(points, np.float64).reshape(len(own), -1)
    g = Graph.__new__(Graph)
    g.frame = Frame(x)
    g.points, g.entry = np.ascontiguousarray(g.frame(x)), entry
    g.edges = np.frombuffer(edges, np.int32).reshape(len(own), -1)
    return own, x, g


def nearest(rows: DataFrame, id_col: str, vector: str, is_query: Column, k: int = 10, shard: int | None = None, degree: int = 32, beam: int = 64, search_beam: int = 192, block: int = 8192) -> DataFrame:
    """query_id, rank (from 1), id_col and score (Euclidean distance): the k nearest found of each query row, itself left out.

    A shard holds 4096 points, more (up to 65,536) as their number grows: n / 64. A graph is sent
    to as many tasks as there are blocks of queries, so what is shuffled grows with n times the
    number of queries over `block`.
    """
    good = rows.where(usable(F.col(vector)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), plain(F.col(vector)).alias("vec"), is_query.alias("asked"))
    first = Window.partitionBy("vec").orderBy("id")  # of a class of copies only so many members can be in a result; each task drops the others before the shuffle
    members = good.select("id", "vec", F.row_number().over(first).alias("_k")).where(F.col("_k") <= k + 1)
    members = stash(members.select("id", "vec", "_k", F.first("id").over(first).alias("class_id")), "members")
    distinct = members.where("_k = 1").select("id", "vec")
    n = distinct.count()
    shards = max(1, -(-n // (shard or min(65_536, max(4096, n // 64)))))
    graphs = stash(build(distinct, shards, degree, beam), "graphs")
    asked = good.where("asked").select(F.col("id").alias("query_id"), "vec")
    queries = asked.groupBy("vec").agg(F.min("query_id").alias("q"))  # copies among the queries are searched once
    n_blocks = max(1, -(-queries.count() // block))
    blocks = queries.withColumn("dim", F.size("vec")).withColumn("b", F.pmod(F.xxhash64("q"), F.lit(n_blocks)).cast("int")).groupBy("dim", "b").agg(F.collect_list(F.struct("q", "vec")).alias("queries"))
    work = graphs.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).join(blocks, ["dim", "b"]).repartition(min(4 * shards * n_blocks, 20_000), "dim", "shard", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, x, g = _load(*(batch.column(c)[at].as_py() for c in ("ids", "points", "entry", "edges")))
                own = batch.column("queries").slice(at, 1).flatten()
                q, every = own.field("q").to_numpy(), matrix(own.field("vec"))
                for lo in range(0, len(q), 256):
                    y = every[lo : lo + 256]
                    found, _, _ = g.search(g.frame(y), search_beam)
                    exact = euclidean(x[found], y[:, None, :])
                    exact[found < 0] = np.inf
                    best = np.lexsort((ids[found], exact, found < 0), axis=1)[:, : k + 1]
                    found, exact = np.take_along_axis(found, best, axis=1), np.take_along_axis(exact, best, axis=1)
                    line, col = np.nonzero(found >= 0)
                    yield pa.RecordBatch.from_pydict({"q": pa.array(q[lo : lo + 256][line]), "id": pa.array(ids[found[line, col]]), "score": pa.array(exact[line, col])})

    near = work.select("ids", "points", "entry", "edges", "queries").mapInArrow(run, "q long, id long, score double")
    # a class counts once here, its members follow; the query's own class can take one place
    best = near.withColumn("_k", F.row_number().over(Window.partitionBy("q").orderBy("score", "id"))).where(F.col("_k") <= k + 1).drop("_k")
    every = asked.join(queries, "vec").select("query_id", "q")
    pairs = every.join(best, "q").join(members.select("class_id", F.col("id").alias("member")), F.col("id") == F.col("class_id")).where("member <> query_id").select("query_id", F.col("member").alias(id_col), "score")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", id_col)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
