"""Embedding near-dedup by collision-counting projections.

Unit vectors are projected onto many random lines. Each vector is the centre of a window on each
of `counted` lines, the windows that another vector falls into are counted, and pairs with at
least the calibrated count are verified by cosine in double precision. On its own that visits
most pairs: a window wide enough for cosine 0.9 holds a third of all vectors on a line. So
vectors are sorted by `gates` further lines into cells first, and windows are counted within a
cell. The number of gates grows with the logarithm of the number of vectors, so that cells keep
their size; the number of tables then follows from the recall asked for at the threshold (where
it is least), and so does the count that a pair must reach. A pair is taken in the first table
in which it meets, so it is counted once; a task yields link counts per vector and a spanning
forest, no pairs. Vectors move once per table, in single precision where that holds them exactly.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components link
with nothing and are their own component; exact copies are one class, whose members link with
each other; vectors of different lengths never link; repeated ids are separate vectors; a row
without an id gets no component; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetgraph.llm.blocks import block_tasks, deal
from sheetgraph.llm.common import stash
from sheetgraph.operators.components import connected_components
from sheetgraph.llm.simhash import forest
from sheetgraph.llm.vectors import classes, matrix, plain, usable


def _phi(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


@dataclass(frozen=True)
class Plan:
    """Widths and numbers of lines for n vectors whose links have cosine >= threshold."""

    threshold: float
    gates: int
    tables: int
    width: float
    counted: int
    window: float
    least: int
    seed: int = 20_001

    @staticmethod
    def of(n: int, threshold: float, recall: float = 0.99, counted: int = 32, cell: int = 4000) -> "Plan":
        near, far = math.sqrt(2 - 2 * threshold), math.sqrt(2.0)
        width = 4 * near

        def same(d: float) -> float:  # chance that two values d apart share a cell of that width, on a random line
            r = width / d
            return 1 - 2 * _phi(-r) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))

        gates = max(1, math.ceil(math.log(max(n, 1) / cell) / -math.log(same(far)))) if n > cell else 1
        tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - same(near) ** gates)))
        window = 1.5 * near
        p = 2 * _phi(window / near) - 1
        least, tail = counted, p**counted
        while tail < 0.998:  # chance of at least `least` collisions of a pair at the threshold
            least -= 1
            tail += math.comb(counted, least) * p**least * (1 - p) ** (counted - least)
        return Plan(threshold, gates, tables, width, counted, window, least)

    def lines(self, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rng = np.random.default_rng([self.seed, dim])
        return rng.standard_normal((dim, self.gates * self.tables)), rng.uniform(0, self.width, self.gates * self.tables), rng.standard_normal((dim, self.counted))

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """A 64-bit key for each vector (row) and table (column)."""
        a, shift, _ = self.lines(unit.shape[1])
        place = np.floor((unit @ a + shift) / self.width).astype(np.int64).reshape(len(unit), self.tables, self.gates).astype(np.uint64)
        key = np.full(place.shape[:2], 0x9E3779B97F4A7C15 ^ unit.shape[1], np.uint64)
        with np.errstate(over="ignore"):
            for g in range(self.gates):
                key = (key ^ place[:, :, g]) * np.uint64(0xBF58476D1CE4E5B9)
                key ^= key >> np.uint64(29)
        return key.view(np.int64)


def _unit(m: np.ndarray) -> np.ndarray:
    scale = np.abs(m).max(axis=1, keepdims=True)
    m = m / scale
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _packed(m: np.ndarray) -> list[bytes]:
    """Each row's bytes, in single precision where that holds it exactly."""
    with np.errstate(over="ignore"):
        single = m.astype("<f4")
    exact = (single == m).all(axis=1)
    return [(a if ok else b).tobytes() for a, b, ok in zip(single, m.astype("<f8"), exact.tolist(), strict=True)]


def _unpacked(rows: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(rows), dim))
    short = np.fromiter((len(r) == 4 * dim for r in rows), bool, len(rows))
    out[short] = np.frombuffer(b"".join(r for r, k in zip(rows, short.tolist(), strict=True) if k), "<f4").reshape(-1, dim)
    out[~short] = np.frombuffer(b"".join(r for r, k in zip(rows, short.tolist(), strict=True) if not k), "<f8").reshape(-1, dim)
    return out


def _cells(plan: Plan, distinct: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = np.diff(b.column("vec").offsets.to_numpy())
            for dim in np.unique(lengths):
                own = b.filter(pa.array(lengths == dim))
                for lo in range(0, own.num_rows, 2048):
                    part = own.slice(lo, 2048)
                    m = matrix(part.column("vec"))
                    keys, packed = plan.cells(_unit(m)), pa.array(_packed(m), pa.binary())
                    for t in range(plan.tables):
                        yield pa.RecordBatch.from_arrays([part.column("id"), packed, pa.array(np.full(part.num_rows, dim, np.int32)), part.column("n"), pa.array(np.full(part.num_rows, t, np.int32)), pa.array(keys[:, t])], ["id", "vec", "dim", "n", "t", "cell"])

    return distinct.mapInArrow(run, "id long, vec binary, dim int, n long, t int, cell long")


def _windows(p: np.ndarray, window: float) -> tuple[np.ndarray, np.uint16]:
    """Projections as steps on a 16-bit ring, and the reach of a window there, rounded up.

    A pair beyond the ring's end may seem to collide; a pair within the window always does.
    """
    step = window / 512
    return np.floor(p / step).astype(np.int64).astype(np.uint16), np.uint16(513)


def _links(plan: Plan, dealt: DataFrame, block: int = 512) -> DataFrame:
    """id, other (both distinct ids; the forest) with n_links null, or id with n_links (rows linked within the task)."""

    def compare(t: int, ids: np.ndarray, vecs: np.ndarray, n: np.ndarray, group: np.ndarray, first: np.ndarray, apart: bool):
        unit = _unit(vecs)
        _, _, lines = plan.lines(unit.shape[1])
        steps, reach = _windows(unit @ lines, plan.window)
        keys = plan.cells(unit)[:, :t] if t else None
        found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo in range(0, len(ids), 256):
            q = slice(lo, lo + 256)
            count = np.zeros((len(steps[q]), len(steps)), np.int8)
            for line in range(plan.counted):  # each of q is the centre of a window
                gap = np.subtract.outer(steps[q, line] + reach, steps[:, line])
                count += gap <= 2 * reach
            ok = (count >= plan.least) & (group[q][:, None] == group[None, :])
            ok &= (first[q][:, None] & ~first[None, :]) if apart else (np.arange(len(ids))[q][:, None] < np.arange(len(ids))[None, :])
            i, j = np.nonzero(ok)
            i += lo
            if t and len(i):
                new = ~(keys[i] == keys[j]).any(axis=1)
                i, j = i[new], j[new]
            for at in range(0, len(i), 65536):
                a, b = i[at : at + 65536], j[at : at + 65536]
                near = (unit[a] * unit[b]).sum(axis=1) >= plan.threshold
                found_i.append(a[near])
                found_j.append(b[near])
        i, j = np.concatenate(found_i), np.concatenate(found_j)
        if not len(i):
            return None
        got = np.bincount(i, n[j], len(ids)) + np.bincount(j, n[i], len(ids))
        some = np.flatnonzero(got)
        low = forest(len(ids), i, j)
        child = np.flatnonzero(low != np.arange(len(ids)))
        return pa.RecordBatch.from_pydict(
            {
                "id": pa.array(np.concatenate([ids[some], ids[child]])),
                "n_links": pa.array([*map(int, got[some]), *[None] * len(child)], pa.int64()),
                "other": pa.array([*[None] * len(some), *ids[low[child]].tolist()], pa.int64()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            held, out = take(held, False)
            yield from out
        if held is not None:
            yield from take(held, True)[1]

    def take(rows: pa.Table, last: bool):
        rows = rows.combine_chunks()
        key = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("t", "cell", "_i", "_j")])
        edge = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, [key.shape[1]]]).tolist()
        if not last:
            edge.pop()
        out, start = [], 0

        def flush(lo: int, hi: int) -> None:
            if hi - lo < 2:
                return
            part = rows.slice(lo, hi - lo).combine_chunks()
            group = np.cumsum(np.concatenate([[0], (key[:, lo + 1 : hi] != key[:, lo : hi - 1]).any(axis=0)]))
            made = compare(int(key[0, lo]), part.column("id").to_numpy(), _unpacked(part.column("vec").to_pylist(), int(dims[lo])), part.column("n").to_numpy().astype(float), group, part.column("_first").to_numpy(zero_copy_only=False), bool(key[2, lo] != key[3, lo]))
            if made is not None:
                out.append(made)

        dims = rows.column("dim").to_numpy()
        for lo, hi in zip(edge, edge[1:], strict=False):
            alone = key[2, lo] != key[3, lo] or hi - lo >= block
            if start < lo and (alone or hi - start > block or key[0, lo] != key[0, start] or dims[lo] != dims[start]):
                flush(start, lo)
                start = lo
            if alone:
                flush(lo, hi)
                start = hi
        end = edge[-1] if edge else 0
        if last and start < end:
            flush(start, end)
            start = end
        return rows.slice(start), out

    return dealt.select("id", "vec", "dim", "n", "t", "cell", "_i", "_j", "_first").mapInArrow(run, "id long, n_links long, other long")


def near_duplicates(rows: DataFrame, id_col: str, vector: str, threshold: float = 0.9, recall: float = 0.99, most: int = 2048) -> DataFrame:
    """id_col, n_links, component_id and kept, for every row."""
    distinct = stash(classes(rows, id_col, vector), "vectors")
    plan = Plan.of(distinct.count(), threshold, recall)
    dealt = block_tasks(deal(_cells(plan, distinct), ["t", "cell"], "id", most), ["t", "cell"])
    found = stash(_links(plan, dealt), "links")
    linked = found.where("n_links is not null").groupBy("id").agg(F.sum("n_links").alias("linked"))
    joined = connected_components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    of_class = distinct.join(linked, "id", "left").join(joined, F.col("id") == F.col("node"), "left").select("vec", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    every = rows.select(F.col(id_col).cast("long").alias(id_col), F.when(usable(F.col(vector)) & F.col(id_col).isNotNull(), plain(F.col(vector))).alias("vec"))
    out = every.join(of_class, "vec", "left").select(id_col, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", id_col).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
