"""Byte-level BPE encoding and decoding.

Merges are found with a segment tree over byte positions: a leaf holds the rank of the pair
that starts there (or none), an inner node the leftmost least rank below it. Each merge
changes two leaves, the merged pair's and its live left neighbour's, in logarithmic time, so
a piece of n bytes takes O(n log n) whatever its length. A worker keeps the ids of the first
`limit` distinct pieces it meets; others are encoded anew.

Edge cases: a null text counts as empty (no ids); a null doc_id is kept; repeated rows give
repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetgraph.llm.common import split_batches

_NONE = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: on each line a token in base 64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: always the leftmost pair of least rank is merged next."""
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    tree = [_NONE] * (2 * size)
    for i in range(n - 1):
        tree[size + i] = ranks.get(piece[i : i + 2], _NONE)
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a <= b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of live parts, by the position of their first byte
    get = ranks.get

    def put(i: int, rank: int) -> None:
        i += size
        tree[i] = rank
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            least = a if a <= b else b
            if tree[i] == least:
                break
            tree[i] = least
            i >>= 1

    while tree[1] < _NONE:
        i, least = 1, tree[1]
        while i < size:
            i *= 2
            if tree[i] != least:
                i += 1
        at = i - size
        gone = after[at]
        end = after[gone]
        after[at] = end
        if end < n:
            before[end] = at
        put(gone, _NONE)
        put(at, get(piece[at : after[end]], _NONE) if end < n else _NONE)
        left = before[at]
        if left >= 0:
            put(left, get(piece[left:end], _NONE))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


class ByteBPE:
    """Encodes texts to little-endian unsigned 32-bit ids, and decodes those."""

    def __init__(self, path: str, pattern: str, limit: int = 500_000):
        import regex

        self._ranks = load_ranks(path)
        self._find = regex.compile(pattern).findall
        self._limit = limit
        self._known: dict[str, bytes] = {}
        tokens = [b""] * (max(self._ranks.values(), default=-1) + 1)
        for token, rank in self._ranks.items():
            tokens[rank] = token
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._ends = np.cumsum([0, *map(len, tokens)])

    def _new(self, piece: str) -> bytes:
        raw = piece.encode("utf-8")
        rank = self._ranks.get(raw)
        ids = np.array([rank] if rank is not None else merge(raw, self._ranks), "<u4").tobytes()
        if len(self._known) < self._limit and len(piece) < 200:
            self._known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        pieces = self._find(text)
        try:
            return b"".join(map(self._known.__getitem__, pieces))
        except KeyError:
            known, new = self._known, self._new
            return b"".join([known.get(p) or new(p) for p in pieces])

    def decode(self, ids: bytes) -> bytes:
        k = np.frombuffer(ids, "<u4").astype(np.int64)
        start = self._ends[k]
        n = self._ends[k + 1] - start
        return self._bytes[np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)].tobytes()


_WORKER: dict[tuple[str, str], ByteBPE] = {}


def worker_bpe(path: str, pattern: str) -> ByteBPE:
    if (path, pattern) not in _WORKER:
        _WORKER[path, pattern] = ByteBPE(path, pattern)
    return _WORKER[path, pattern]


def encode(docs: DataFrame, ranks: str, pattern: str, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens and ids (binary, little-endian unsigned 32-bit).

    With digests, the ids are decoded again and only the SHA-256 of the ids and of the decoded bytes are returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(ranks, pattern)
        for b in split_batches(batches, 256):
            ids = [bpe.encode(t or "") for t in b.column("text").to_pylist()]
            columns = {"doc_id": b.column("doc_id"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64())}
            if digests:
                columns["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())
                columns["decoded_sha256"] = pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids], pa.string())
            else:
                columns["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids binary"))


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and the text of rows that encode() made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(ranks, pattern)
        for b in split_batches(batches, 256):
            texts = [bpe.decode(x or b"").decode("utf-8", "replace") for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
