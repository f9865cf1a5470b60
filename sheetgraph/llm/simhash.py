"""SimHash near-dedup with a bit-sliced comparison.

Distinct fingerprints are bucketed by two of four 16-bit quarters (two fingerprints that
differ in at most two bits agree in at least two quarters, so no link is lost). In a block,
the fingerprints' bits are stored vertically, 64 fingerprints to a word; the distances of
many pairs are updated together by carry-save counters, bit plane by bit plane, and rows
whose lanes all exceed the radius are abandoned. A block yields a spanning forest of its
links, never its pairs; components are found over those edges.

Edge cases: a null or empty text has fingerprint zero, linked like any other; a text of fewer
than `words` words has its whole sequence as one shingle; repeated rows share a class; a row
with a null doc_id gets its class's component, null if no member has an id; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetgraph.llm.blocks import block_tasks, deal
from sheetgraph.llm.common import split_batches, stash, text_bytes
from sheetgraph.operators.components import connected_components


def fingerprint(text: bytes, words: int = 3) -> int:
    """Unsigned 64-bit SimHash of the shingles' XXH64 (seed 42)."""
    import xxhash

    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        spans = [joined]
    else:
        n = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        end = np.cumsum(n) - 1
        start = end + 1 - n
        spans = [joined[a:b] for a, b in zip(start[: len(parts) - words + 1].tolist(), end[words - 1 :].tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in spans], dtype=">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in split_batches(batches, 512):
            fps = np.array([fingerprint(t, words) for t in text_bytes(b.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "fp": pa.array(fps)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def close_pairs(fps: np.ndarray, others: np.ndarray | None = None, radius: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of pairs that differ in at most `radius` bits.

    Within fps with i < j, or between fps and others. Fingerprints are words, or rows of words.
    """
    lanes = fps if others is None else others
    mine, theirs = (np.unpackbits(np.ascontiguousarray(x.reshape(len(x), -1).astype(">u8")).view(np.uint8), axis=1) for x in (fps, lanes))
    n, width, n_bits = len(lanes), -(-len(lanes) // 64), mine.shape[1]
    bits = np.zeros((width * 64, n_bits), np.uint8)
    bits[:n] = theirs
    planes = _words(bits.T)
    index = np.arange(width * 64)
    closed = np.broadcast_to(index >= n, (len(fps), width * 64)) if others is not None else (index[None, :] <= np.arange(n)[:, None]) | (index >= n)
    over = _words(closed.astype(np.uint8))
    own = mine.astype(np.uint64) * np.uint64(0xFFFFFFFFFFFFFFFF)
    rows = np.arange(len(fps))
    counters = [np.zeros_like(over) for _ in range(max(1, radius.bit_length()))]
    for bit in range(n_bits):
        carry = planes[bit][None, :] ^ own[:, bit][:, None]
        for c in counters:  # carry-save: what a counter can't hold goes on to the next, beyond the last the lane is over
            more = c & carry
            c ^= carry
            carry = more
        over |= carry
        if bit % 8 == 7:
            live = (~(over | _above(counters, radius))).any(axis=1)
            if not live.all():
                rows, own, over, counters = rows[live], own[live], over[live], [c[live] for c in counters]
                if not len(rows):
                    break
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left = ~(over | _above(counters, radius))
    i, j = np.nonzero(np.unpackbits(np.ascontiguousarray(left).view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little"))
    return rows[i], j


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of 64 w bits as rows of w words, the first bit lowest."""
    return np.ascontiguousarray(np.packbits(np.ascontiguousarray(bits), axis=1, bitorder="little")).view("<u8")


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count, lowest bit first, is over the radius."""
    above, same = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            same &= counters[k]
        else:
            above |= same & counters[k]
            same &= ~counters[k]
    return above


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node it reaches over the links (i, j)."""
    low = np.arange(n)
    while len(i):
        before = low.copy()
        np.minimum.at(low, i, low[j])
        np.minimum.at(low, j, low[i])
        low = low[low]
        if (low == before).all():
            break
    return low


def links(distinct: DataFrame, radius: int = 2, most: int = 1024, block: int = 256) -> DataFrame:
    """Edges (a, b) over the column fp of distinct fingerprints that connect all that are within the radius."""
    quarter = [F.shiftrightunsigned("fp", 16 * k).bitwiseAND(0xFFFF) for k in range(4)]
    pairs = [(a, b) for a in range(4) for b in range(a)]
    keyed = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), (quarter[a] * 65536 + quarter[b]).alias("k")) for t, (a, b) in enumerate(pairs)])).alias("x")).select("x.t", "x.k", "fp")

    def flush(fps: np.ndarray, first: np.ndarray, split: bool) -> pa.RecordBatch:
        if split:
            a, b = np.flatnonzero(first), np.flatnonzero(~first)
            i, j = close_pairs(fps[a], fps[b], radius)
            i, j = a[i], b[j]
        else:
            i, j = close_pairs(fps, None, radius)
        low = forest(len(fps), i, j)
        k = np.flatnonzero(low != np.arange(len(fps)))
        return pa.RecordBatch.from_pydict({"a": pa.array(fps[k].view(np.int64)), "b": pa.array(fps[low[k]].view(np.int64))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for b in batches:
            held.append(np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("t", "k", "_i", "_j", "_first", "fp")]))
            rows = np.concatenate(held, axis=1)
            change = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0)) + 1
            done = int(change[-1]) if len(change) else 0
            if done >= block:
                yield from groups(rows[:, :done])
                rows = rows[:, done:]
            held = [rows]
        if held:
            yield from groups(np.concatenate(held, axis=1))

    def groups(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole blocks; small ones are compared together, since a link between two of them is true as well."""
        edge = np.concatenate([[0], np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0)) + 1, [rows.shape[1]]]).tolist()
        fps, first, apart = rows[5].view(np.uint64), rows[4].astype(bool), rows[2] != rows[3]
        start = 0
        for lo, hi in zip(edge, edge[1:], strict=False):
            if apart[lo] if hi > lo else False:
                if lo > start:
                    yield flush(fps[start:lo], first[start:lo], False)
                yield flush(fps[lo:hi], first[lo:hi], True)
                start = hi
            elif hi - start >= block:
                yield flush(fps[start:hi], first[start:hi], False)
                start = hi
        if start < rows.shape[1]:
            yield flush(fps[start:], first[start:], False)

    return block_tasks(deal(keyed, ["t", "k"], "fp", most), ["t", "k"]).select("t", "k", "_i", "_j", "_first", "fp").mapInArrow(run, "a long, b long")


def cluster(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fp and component_id (the least doc_id reachable over links, its own included)."""
    marked = stash(fingerprints(docs, words), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = stash(connected_components(links(distinct.select("fp"), radius)), "classes").withColumnRenamed("node", "fp")
    classes = distinct.join(found, "fp", "left").select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    lowest = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return marked.join(classes.join(lowest, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")
