"""Token-ID / binary output: best-fit-decreasing packing into fixed windows.

Each task reads its rows in order and cuts them into cells of about `cell_tokens` tokens;
a cell is packed on its own, so nothing is shuffled, memory is bounded by a cell (or by the
longest document) and a lost task is repeated with the same result.

Edge cases: a null or empty text is its end id alone; a null doc_id is kept as null; repeated
rows are packed as often as they occur; an empty table gives an empty result; other columns
are ignored, whatever their names. A document longer than the window is cut into full
windows and a rest, without losing an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetgraph.llm.common import split_batches, text_bytes
from sheetgraph.llm.wordbpe import worker_encoder


class CapacityTree:
    """Which free capacities have an open bin: a segment tree of counts over 0..top."""

    def __init__(self, top: int):
        self._size = 1 << top.bit_length()
        self._count = [0] * (2 * self._size)
        self._bins: list[list[int]] = [[] for _ in range(top + 1)]

    def put(self, capacity: int, bin_: int) -> None:
        self._bins[capacity].append(bin_)
        i = capacity + self._size
        while i:
            self._count[i] += 1
            i >>= 1

    def take_best(self, length: int) -> tuple[int, int] | None:
        """Remove and return (capacity, bin) of the smallest capacity of at least length, the oldest stack's last bin."""
        count, i = self._count, length + self._size
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self._size:
                i <<= 1
                if not count[i]:
                    i += 1
        capacity = i - self._size
        while i:
            count[i] -= 1
            i >>= 1
        return capacity, self._bins[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, int]:
    """The bin of each piece (lengths of 1..window) and the number of bins; equal lengths keep their order."""
    tree, bins, n = CapacityTree(window), np.zeros(len(lengths), np.int64), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        found = tree.take_best(size)
        if found is None:
            found, n = (window, n), n + 1
        bins[k] = found[1]
        if found[0] > size:
            tree.put(found[0] - size, found[1])
    return bins, n


def cut(counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces of documents with those token counts: full windows and a rest."""
    pieces = -(-counts // window)
    doc = np.repeat(np.arange(len(counts)), pieces)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
    return doc, start, np.minimum(window, counts[doc] - start)


def cells(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, cell_tokens: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc_ids, token counts, ids one after another) of cells of about cell_tokens tokens; each document ends with end_id."""
    encoder = worker_encoder(tokenizer)
    docs, counts, parts, held = [], [], [], 0

    def full():
        return docs, np.concatenate(counts), np.concatenate(parts)

    for b in split_batches(batches, 256):
        ids, n = encoder.encode_many(text_bytes(b.column("text")))
        docs += b.column("doc_id").to_pylist()
        ends = np.cumsum(n)
        parts.append(np.insert(ids, ends, np.uint16(end_id)))
        counts.append(n + 1)
        held += len(parts[-1])
        if held >= cell_tokens:
            yield full()
            docs, counts, parts, held = [], [], [], 0
    if docs:
        yield full()


PACKED = "sequence_id long, n_tokens int, n_segments int, ids binary, position_ids binary, cu_seqlens array<int>, segments array<struct<doc_id:long,start:long,length:int>>"


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, pad_id: int = 0, cell_tokens: int = 3_000_000) -> DataFrame:
    """One row per sequence of `window` ids.

    ids and position_ids are little-endian unsigned 16-bit integers, padded with pad_id and 0
    to the window; position_ids start anew at 0 with each segment; cu_seqlens are the ends of
    the segments, after a 0; segments name each segment's document and its first id there.
    """

    def run(batches):
        base, n_cell_bins = TaskContext.get().partitionId() << 33, 0
        for ids_of, counts, flat in cells(batches, tokenizer, end_id, cell_tokens):
            first = np.cumsum(counts) - counts
            doc, start, length = cut(counts, window)
            bins, n = best_fit_decreasing(length, window)
            order = np.argsort(bins, kind="stable")
            doc, start, length, bins = doc[order], start[order], length[order], bins[order]
            edge = np.searchsorted(bins, np.arange(n + 1))
            at = np.cumsum(length) - length
            within = at - at[edge[:-1]][bins]
            source = np.arange(int(length.sum())) + np.repeat(first[doc] + start - at, length)
            target = np.arange(len(source)) + np.repeat(bins * window + within - at, length)
            for lo in range(0, n, 512):
                hi = min(n, lo + 512)
                a, b = int(edge[lo]), int(edge[hi])
                s, e = int(at[a]), int(at[b - 1] + length[b - 1])
                matrix, positions = np.full((hi - lo) * window, pad_id, np.uint16), np.zeros((hi - lo) * window, np.uint16)
                here = target[s:e] - lo * window
                matrix[here] = flat[source[s:e]]
                positions[here] = np.arange(s, e) - np.repeat(at[a:b], length[a:b])
                rows, offsets = hi - lo, pa.array(edge[lo : hi + 1] - a, pa.int32())
                sizes = np.diff(edge[lo : hi + 1])
                used = np.add.reduceat(length[a:b], edge[lo:hi] - a)
                cu = np.insert(within[a:b] + length[a:b], edge[lo:hi] - a, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(base + n_cell_bins + np.arange(lo, hi)),
                        pa.array(used, pa.int32()),
                        pa.array(sizes, pa.int32()),
                        _rows(matrix, rows, window),
                        _rows(positions, rows, window),
                        pa.ListArray.from_arrays(pa.array(edge[lo : hi + 1] - a + np.arange(rows + 1), pa.int32()), pa.array(cu, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array([ids_of[k] for k in doc[a:b].tolist()], pa.int64()), pa.array(start[a:b], pa.int64()), pa.array(length[a:b], pa.int32())], ["doc_id", "start", "length"])),
                    ],
                    ["sequence_id", "n_tokens", "n_segments", "ids", "position_ids", "cu_seqlens", "segments"],
                )
            n_cell_bins += n

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PACKED)


def _rows(flat: np.ndarray, rows: int, window: int) -> pa.Array:
    data = np.ascontiguousarray(flat.astype("<u2"))
    offsets = np.arange(rows + 1, dtype=np.int32) * (window * 2)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def write_packed(packed: DataFrame, path: str) -> None:
    """Store the packed sequences; read_packed() gives them back in order of sequence_id."""
    packed.write.mode("overwrite").parquet(path)


def read_packed(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).orderBy("sequence_id")
