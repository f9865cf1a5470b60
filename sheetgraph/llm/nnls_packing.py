"""Packing by non-negative least squares over shallow length combinations.

A cell's rests (what remains of each document after its full windows) are counted in bins
of `unit` tokens. All combinations of up to `depth` bins that fill a window make the columns
of a matrix; non-negative least squares finds how often to use each so that the histogram is
met; the counts are rounded down and carried out, and what is left is packed greedily. Gaps
of `least_fill` tokens or more are then filled with pieces cut from the left-over documents,
the remaining ids fill whole windows, and the last ids of a cell go to sequences whose
lengths are powers of two, which need no padding.

Edge cases: a null or empty text is its end id alone; a null doc_id is kept as null; repeated
rows are packed as often as they occur; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetgraph.llm.bfd_packing import cells


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 0) -> np.ndarray:
    """The non-negative x with the least |a x - b| (active sets, Lawson and Hanson)."""
    ata, atb = a.T @ a, a.T @ b
    n = len(atb)
    x, on = np.zeros(n), np.zeros(n, bool)
    gain = atb.copy()
    tol = 1e-9 * max(1.0, float(np.abs(atb).max(initial=0)))
    for _ in range(rounds or 3 * a.shape[0] + 10):
        gain_off = np.where(on, -np.inf, gain)
        j = int(np.argmax(gain_off))
        if gain_off[j] <= tol:
            break
        on[j] = True
        while True:
            k = np.flatnonzero(on)
            z = np.linalg.lstsq(ata[np.ix_(k, k)], atb[k], rcond=None)[0]
            if (z > 0).all():
                break
            bad = z <= 0
            step = float((x[k][bad] / np.maximum(x[k][bad] - z[bad], 1e-300)).min())
            x[k] += step * (z - x[k])
            on[k[x[k] <= 1e-12]] = False
            x[~on] = 0
            if not on.any():
                break
        x[:] = 0
        k = np.flatnonzero(on)
        if len(k):
            x[k] = z
        gain = atb - ata @ x
    return x


@lru_cache(maxsize=4)
def combinations(units: int, depth: int) -> np.ndarray:
    """Every multiset of up to `depth` positive bin sizes that sums to `units`, as rows of counts by size."""
    found: list[list[int]] = []

    def go(rest: int, most: int, left: int, own: list[int]) -> None:
        if rest == 0:
            found.append(own)
        elif left:
            for k in range(min(rest, most), 0, -1):
                if k * left < rest:
                    break
                go(rest - k, k, left - 1, [*own, k])

    go(units, units, depth, [])
    out = np.zeros((len(found), units + 1))
    for row, own in enumerate(found):
        for k in own:
            out[row, k] += 1
    return out


def pack_lengths(counts: np.ndarray, window: int, unit: int, depth: int, least_fill: int) -> list[list[tuple[int, int, int]]]:
    """Sequences, each a list of (document, start, length), that hold every token of the documents once."""
    out: list[list[tuple[int, int, int]]] = []
    whole = counts // window
    for d in np.flatnonzero(whole).tolist():
        out += [[(d, k * window, window)] for k in range(int(whole[d]))]
    rest = counts - whole * window
    by: dict[int, list[int]] = defaultdict(list)
    for d in np.flatnonzero(rest).tolist():
        by[-(-int(rest[d]) // unit)].append(d)
    units = window // unit
    histogram = np.zeros(units + 1)
    for k, own in by.items():
        histogram[k] = len(own)
    columns = combinations(units, depth)
    usable = columns[(columns[:, histogram == 0] == 0).all(axis=1)]
    made: list[tuple[list[int], int]] = []  # documents, gap
    if len(usable):
        times = np.floor(nnls(usable.T, histogram) + 1e-6).astype(int)
        for row in np.argsort(-times, kind="stable").tolist():
            bins = [(int(k), int(usable[row, k])) for k in np.flatnonzero(usable[row])]
            for _ in range(int(times[row])):
                if any(len(by[k]) < n for k, n in bins):
                    break
                own = [by[k].pop() for k, n in bins for _ in range(n)]
                made.append((own, window - sum(int(rest[d]) for d in own)))
    # residuals: first fit into open sequences by length, largest first
    open_: dict[int, list[list[int]]] = defaultdict(list)
    left = sorted((d for own in by.values() for d in own), key=lambda d: (-int(rest[d]), d))
    top = 0
    for d in left:
        need = int(rest[d])
        slot = next((c for c in range(-(-need // unit), top + 1) if open_[c] and open_[c][-1][0] >= need), None)
        gap, own = open_[slot].pop() if slot is not None else [window, []]
        own.append(d)
        gap -= need
        open_[gap // unit].append([gap, own])
        top = max(top, gap // unit)
    made += [(own, gap) for bins in open_.values() for gap, own in bins]
    # the sequences with the largest gaps are dissolved: their ids fill the other gaps
    made.sort(key=lambda x: (x[1], x[0]))
    fill = sum(gap for _, gap in made if gap >= least_fill)
    loose: list[list[int]] = []
    have = 0
    while made and have < fill:
        own, gap = made.pop()
        fill -= gap if gap >= least_fill else 0
        have += window - gap
        loose += [[d, int(whole[d]) * window, int(rest[d])] for d in own]
    loose.reverse()

    def take(n: int) -> list[tuple[int, int, int]]:
        got = []
        while n and loose:
            d, start, length = loose[-1]
            k = min(n, length)
            got.append((d, start, k))
            n -= k
            if k == length:
                loose.pop()
            else:
                loose[-1][1:] = [start + k, length - k]
        return got

    for own, gap in made:
        pieces = [(d, int(whole[d]) * window, int(rest[d])) for d in own]
        out.append(pieces + (take(gap) if gap >= least_fill else []))
    total = sum(x[2] for x in loose)
    while total:
        size = min(window, 1 << (total.bit_length() - 1))
        out.append(take(size))
        total -= size
    return out


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, unit: int = 32, depth: int = 3, least_fill: int = 8, cell_tokens: int = 3_000_000, with_ids: bool = False) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence; with_ids adds the ids (array of int)."""

    def run(batches):
        base, n = TaskContext.get().partitionId() << 33, 0
        for ids_of, counts, flat in cells(batches, tokenizer, end_id, cell_tokens):
            sequences = pack_lengths(counts, window, unit, depth, least_fill)
            first = (np.cumsum(counts) - counts).tolist()
            wide = np.ascontiguousarray(flat.astype("<u4"))
            rows = [(d, s, k, q) for q, own in enumerate(sequences) for d, s, k in own]
            doc, start, length, seq = (np.array(x, np.int64) for x in (zip(*rows, strict=True) if rows else ((), (), (), ())))
            at = np.cumsum(length) - length
            offset = at - at[np.searchsorted(seq, seq)]
            crc = [zlib.crc32(wide[first[d] + s : first[d] + s + k]) for d, s, k, _ in rows]
            columns = [pa.array([ids_of[d] for d, *_ in rows], pa.int64()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(counts[doc]), pa.array(base + n + seq), pa.array(offset)]
            names = [x.split()[0] for x in PIECES.split(", ")]
            if with_ids:
                columns.append(pa.array([wide[first[d] + s : first[d] + s + k].astype(np.int32) for d, s, k, _ in rows], pa.list_(pa.int32())))
                names.append("ids")
            batch = pa.RecordBatch.from_arrays(columns, names)
            for lo in range(0, batch.num_rows, 4096):
                yield batch.slice(lo, 4096)
            n += len(sequences)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))
