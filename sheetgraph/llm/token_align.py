"""Alignment of two tokenizers' ids over the same bytes.

A text is cut before white space that no token of either tokenizer crosses. The ids of each part
are kept per worker, so frequent words are encoded once. Packed bitsets over the bytes of a batch's distinct parts
mark where tokens of A and of B end. Their AND holds the shared cuts, which bound the groups; popcounts
(rank) give the tokens before a cut, set bits in order (select) the cuts. Each set bit of their OR ends
one stretch of bytes in which neither tokenizer ends a token, so it is one link, between the two tokens that
hold the stretch. As each part ends in a shared cut, a text's groups and links are those of its parts.

Counts over the corpus need all texts, so texts are encoded twice: first each task sums up the links of each id pair, which
are then summed by pair; then texts are told the sums. Those of the `popular` most frequent pairs (a bounded table) are
given to all tasks. A text's links of any other pairs, if there are such, are joined with their sums by pair; none of these has a
large share of the rows. Nothing else moves.

Edge cases: texts that are null, empty, or that a tokenizer's tokens don't give back byte for byte have no tokens; null
ids are kept; repeated rows count and are returned each; an empty table gives an empty result; other columns are ignored. Batches
are cut by rows and bytes, so a very long text is a batch of its own. A part is encoded whole: a text of many MB without any
space, tab or line feed needs some 200 bytes of memory for each of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetgraph.llm.common import stash

#: Rows and bytes of text of a batch, at most (a longer text is a batch of its own).
ROWS, BYTES = 1024, 1 << 20
_CUT = re.compile(r"(?<=\S)(?=[ \n\t])")
_SPACE = "▁"


def byte_table() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow from 256 on."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(others)}


def _by_ranks(path: str):
    """A faster encoder with the ids of a byte-level vocabulary file, or None if the file's merges don't make ids in their order.

    Merging the pair whose merge comes first, and merging into the token of the least id, are then the same.
    """
    import json

    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    split = told.get("pre_tokenizer") or {}
    if told.get("normalizer") or told["model"]["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or told["model"].get("ignore_merges"):
        return None
    letter, vocab = byte_table(), told["model"]["vocab"]
    special = {t["content"] for t in told["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
    ids = [vocab["".join(m)] for m in merges]
    if any(b <= a for a, b in zip(ids, ids[1:], strict=False)) or ids[0] <= max(vocab[c] for c in letter) or len(ids) + 256 + len(special) != len(vocab.keys() | special):
        return None
    ranks = {bytes(map(letter.__getitem__, token)): k for token, k in vocab.items() if token not in special}
    return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class PartEncoder:
    """Ids of parts under both tokenizers. The cache keeps the first `limit` parts; others are encoded anew each time."""

    def __init__(self, a_path: str, b_path: str, limit: int = 100_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(a_path)
        self._a.encode_special_tokens = True
        self._ranked = _by_ranks(a_path)
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letter = byte_table()
        n = self._a.get_vocab_size()
        self.a_bytes = [b""] * n
        for token, k in self._a.get_vocab().items():
            self.a_bytes[k] = bytes(map(letter.__getitem__, token)) if all(c in letter for c in token) else token.encode()
        self.b_bytes = []
        pieces = []
        for k in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(k)
            if self._b.is_byte(k):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.b_bytes.append(piece.replace(_SPACE, " ").encode())
                pieces.append(piece)
        if max(n, len(self.b_bytes)) > 1 << 16:
            raise ValueError("ids are held in 16 bits")
        self._whole = any(re.search(f"[^{_SPACE}]{_SPACE}|[\n\t]", p) for p in pieces)  # then parts could share a token
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self._limit = limit
        self._at: dict[str, int] = {}
        self._ids = [np.zeros(1 << 16, np.uint16), np.zeros(1 << 16, np.uint16)]
        self._start = [np.zeros((1 << 14) + 1, np.int64), np.zeros((1 << 14) + 1, np.int64)]
        self._good = np.zeros(1 << 14, bool)
        self._n = 0

    def cut(self, text: str) -> list[str]:
        """The parts of the text with a space before it."""
        return [" " + text] if self._whole else _CUT.split(" " + text)

    def _encode_b(self, text: str) -> list[int]:
        """Ids of a stretch that begins with white space: behind a line feed, which joins nothing, and without the space that the tokenizer puts before all."""
        return self._b.encode(text[1:], num_threads=1) if self._whole else self._b.encode("\n" + text, num_threads=1)[2:]

    def _encode(self, text: str) -> tuple[list[int], list[int], bool]:
        a = self._ranked(text) if self._ranked else self._a.encode(text, add_special_tokens=False).ids
        b = self._encode_b(text)
        raw = text.encode()
        return a, b, b"".join([self.a_bytes[k] for k in a]) == raw and b"".join([self.b_bytes[k] for k in b]) == raw

    def _add(self, parts: list[str]) -> None:
        """Encodes new parts, some thousand at once where they can be told apart by their bytes."""
        regular = [k for k, p in enumerate(parts) if not self._whole and not p[-1].isspace() and _SPACE not in p]
        n = [np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)]
        good = np.zeros(len(parts), bool)
        flat: tuple[list, list] = ([], [])
        order: list[int] = []
        rest = [k for k in range(len(parts)) if k not in set(regular)] if len(regular) < len(parts) else []
        for at in range(0, len(regular), 2000):
            own = regular[at : at + 2000]
            a, b, fine = self._encode("".join([parts[k] for k in own]))
            ends = np.cumsum([len(parts[k].encode()) for k in own])
            cuts = [np.searchsorted(np.cumsum(size[ids]), ends) for size, ids in ((self.a_size, a), (self.b_size, b))] if fine else []
            if fine and all(np.array_equal(np.cumsum(size[ids])[np.minimum(c, len(ids) - 1)], ends) for size, ids, c in ((self.a_size, a, cuts[0]), (self.b_size, b, cuts[1]))):
                order += own
                good[own] = True
                for side, ids in ((0, a), (1, b)):
                    n[side][own] = np.diff(cuts[side], prepend=-1)
                    flat[side].append(np.array(ids, np.uint16))
            else:
                rest += own
        for k in rest:
            a, b, good[k] = self._encode(parts[k])
            order.append(k)
            for side, ids in ((0, a), (1, b)):
                n[side][k] = len(ids)
                flat[side].append(np.array(ids, np.uint16))
        while self._n + len(parts) > len(self._good):
            self._good = np.concatenate([self._good, np.zeros_like(self._good)])
        self._good[self._n : self._n + len(parts)] = good[order]
        for side in (0, 1):
            own = np.concatenate(flat[side])
            used = int(self._start[side][self._n])
            while used + len(own) > len(self._ids[side]):
                self._ids[side] = np.concatenate([self._ids[side], np.zeros_like(self._ids[side])])
            while self._n + len(parts) + 1 > len(self._start[side]):
                self._start[side] = np.concatenate([self._start[side], np.zeros_like(self._start[side])])
            self._ids[side][used : used + len(own)] = own
            self._start[side][self._n + 1 : self._n + len(parts) + 1] = used + np.cumsum(n[side][order])
        self._at.update(zip([parts[k] for k in order], range(self._n, self._n + len(parts)), strict=True))
        self._n += len(parts)

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Number of each part among the batch's distinct parts; of these whether they are given back, and counts and ids under A and B."""
        at, kept = self._at, self._n
        k = np.fromiter(map(at.get, parts, repeat(-1)), np.int64, len(parts))
        missed = np.flatnonzero(k < 0).tolist()
        new = list(dict.fromkeys([parts[i] for i in missed]))
        if new:
            self._add(new)
            k[missed] = [at[parts[i]] for i in missed]
        seen = np.zeros(self._n, bool)
        seen[k] = True
        distinct = np.flatnonzero(seen)
        place = np.zeros(self._n, np.int32)
        place[distinct] = np.arange(len(distinct), dtype=np.int32)
        sides = []
        for side in (0, 1):
            start = self._start[side][distinct]
            n = self._start[side][distinct + 1] - start
            sides.append((n, self._ids[side][np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)]))
        good = self._good[distinct]
        if self._n > self._limit:
            for p in new:
                if at[p] >= max(kept, self._limit):
                    del at[p]
            self._n = max(kept, self._limit)
        return place[k], good, sides[0], sides[1]


class Bits:
    """A packed bitset over byte places, with rank and select."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def of(cls, places: np.ndarray, size: int) -> "Bits":
        flags = np.zeros(-(-(size + 1) // 64) * 64, np.uint8)
        flags[places] = 1
        return cls(np.packbits(flags, bitorder="little").view("<u8"))

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = places >> 6
        mask = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        inside = np.bitwise_count(np.append(self.words, np.uint64(0))[word] & mask)
        return self.before[word] + inside

    def select(self) -> np.ndarray:
        """The places of all set bits."""
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


def align_parts(n_a: np.ndarray, a: np.ndarray, n_b: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> dict[str, np.ndarray]:
    """Groups and links of parts laid one after another, whose ids under A and B have the same bytes.

    cuts_a, cuts_b: tokens of A and B before the end of each group; groups, links: counts by part; pairs: a * 65536 + b of each link in order.
    """
    ends_a, ends_b = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    size = int(ends_a[-1]) if len(ends_a) else 0
    in_a, in_b = Bits.of(ends_a, size), Bits.of(ends_b, size)
    shared, either = Bits(in_a.words & in_b.words), Bits(in_a.words | in_b.words)
    part_end = np.concatenate([[0], ends_a])[np.cumsum(n_a)] + 1
    cuts, links = shared.select(), either.select()
    return {
        "cuts_a": in_a.rank(cuts + 1),
        "cuts_b": in_b.rank(cuts + 1),
        "groups": np.diff(shared.rank(part_end), prepend=0),
        "links": np.diff(either.rank(part_end), prepend=0),
        "pairs": a[in_a.rank(links)].astype(np.int64) << 16 | b[in_b.rank(links)],
    }


def _lists(items: pa.Array, ends: np.ndarray, separator: str) -> pa.Array:
    """Items joined by the separator, in runs that end before each of `ends`."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), items), separator)


_WORKER: dict[tuple[str, str], PartEncoder] = {}


def worker_encoder(a_path: str, b_path: str) -> PartEncoder:
    if (a_path, b_path) not in _WORKER:
        _WORKER[a_path, b_path] = PartEncoder(a_path, b_path)
    return _WORKER[a_path, b_path]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of at most ROWS rows and BYTES bytes of text, one row at least."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < b.num_rows:
            n = max(int(np.searchsorted(np.cumsum(size[at : at + ROWS]), BYTES, side="right")), 1)
            yield b.slice(at, n)
            at += n


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values over runs that end before each of `ends`."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return np.diff(total[ends], prepend=0)


def _ragged(rows: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the items of all rows, one after another, where row r's items end before ends[r]; and the number of each row's items."""
    start = np.concatenate([np.zeros(1, np.int64), ends[:-1]])[rows]
    n = ends[rows] - start
    return np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n), n


class Batch:
    """Texts as parts: `parts` numbers all parts of all texts, text r's before doc_end[r]; n_a .. links count by distinct part; `pairs` holds these parts' links."""

    def __init__(self, encoder: PartEncoder, texts: list[str | None]):
        cut = [encoder.cut(t) if t else [] for t in texts]
        k, good, (n_a, a), (n_b, b) = encoder.encode([p for own in cut for p in own])
        n = np.array([len(x) for x in cut], np.int64)
        fine = _sums((~good[k]).astype(np.int64), np.cumsum(n)) == 0
        self.parts, self.n = k[np.repeat(fine, n)].astype(np.int64), np.where(fine, n, 0)
        self.doc_end = np.cumsum(self.n)
        self.a, self.b, self.n_a, self.n_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a * good, n_b * good
        self.__dict__.update(align_parts(self.n_a, self.a, self.n_b, self.b, encoder.a_size, encoder.b_size))
        self.part_end = np.cumsum(self.links)

    def by_text(self, values: np.ndarray) -> np.ndarray:
        """Sums by text of a value of each distinct part."""
        return _sums(values[self.parts], self.doc_end)

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs of the texts and their numbers of links."""
        pairs, place = np.unique(self.pairs, return_inverse=True)
        often = np.repeat(np.bincount(self.parts, minlength=len(self.n_a)), self.links)
        times = np.bincount(place, weights=often, minlength=len(pairs)).astype(np.int64)
        return pairs[times > 0], times[times > 0]  # a pair of refused texts alone is none

    def said(self, decimal: pa.Array) -> list[str]:
        """The groups of each text, written out."""
        joined = pc.binary_join_element_wise(_lists(decimal.take(pa.array(self.a)), self.cuts_a, ","), _lists(decimal.take(pa.array(self.b)), self.cuts_b, ","), "|")
        group = _lists(joined, np.cumsum(self.groups), ";").to_pylist()
        return [";".join([group[p] for p in self.parts[e - m : e].tolist()]) for e, m in zip(self.doc_end.tolist(), self.n.tolist(), strict=True)]

    def rare(self, told: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times) of the links that are not `told`, by text."""
        own = np.flatnonzero(_sums((~told).astype(np.int64), self.part_end)[self.parts])
        place, n = _ragged(self.parts[own], self.part_end)
        doc = np.repeat(np.searchsorted(self.doc_end, own, side="right"), n)
        odd = ~told[place]
        keys, times = np.unique(np.stack([doc[odd], self.pairs[place[odd]]]), axis=1, return_counts=True)
        return keys[0], keys[1], times


def _summed(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    own, place = np.unique(np.concatenate(pairs), return_inverse=True)
    return own, np.bincount(place, weights=np.concatenate(times), minlength=len(own)).astype(np.int64)


def link_counts(docs: DataFrame, a_path: str, b_path: str, held: int = 500_000) -> DataFrame:
    """(pair, count, best): links of each id pair (a * 65536 + b) over all texts, and whether no pair of its B id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(a_path, b_path)
        pairs, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for b in _slices(batches):
            p, n = Batch(encoder, b.column("text").to_pylist()).counted()
            pairs, times = [*pairs, p], [*times, n]
            if sum(map(len, pairs)) > held:
                own, n = _summed(pairs, times)
                pairs, times = [own], [n]
                if 2 * len(own) > held:
                    yield pa.RecordBatch.from_pydict({"pair": own, "times": n})
                    pairs, times = [own[:0]], [n[:0]]
        own, n = _summed(pairs, times)
        yield pa.RecordBatch.from_pydict({"pair": own, "times": n})

    counts = stash(docs.select("text").mapInArrow(run, "pair long, times long").groupBy("pair").agg(F.sum("times").alias("count")), "pairs")
    most = counts.groupBy(F.expr("pair & 65535").alias("b")).agg(F.max("count").alias("most"))  # at most 65,536 ids of B
    return counts.join(F.broadcast(most), F.expr("pair & 65535") == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, digests: bool = False, popular: int = 65_536) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (`a1,a2|b1;a3|b2,b3`), or its SHA-256 with digests."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = stash(link_counts(docs, a_path, b_path), "counts")
    hot = counts.orderBy(F.col("count").desc(), "pair").limit(popular)
    known = np.array(sorted(map(tuple, hot.collect())), np.int64).reshape(-1, 3)
    name = "groups_sha256" if digests else "groups"
    result = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, decimal = worker_encoder(a_path, b_path), pa.array([str(k) for k in range(1 << 16)], pa.string())
        row = TaskContext.get().partitionId() << 40
        for b in _slices(batches):
            own = Batch(encoder, b.column("text").to_pylist())
            at = np.minimum(np.searchsorted(known[:, 0], own.pairs), max(len(known) - 1, 0))
            told = known[at, 0] == own.pairs if len(known) else np.zeros(len(own.pairs), bool)
            total = lambda c: own.by_text(_sums(known[at, c] * told if len(known) else np.zeros(len(told), np.int64), own.part_end))  # noqa: E731, B023
            said = own.said(decimal)
            if digests:
                said = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said]
            doc, pair, times = own.rare(told) if not told.all() else (np.zeros(0, np.int64),) * 3
            found = pa.StructArray.from_arrays([pa.array(pair, pa.int64()), pa.array(times, pa.int64())], ["pair", "times"])
            numbers = {"n_a": own.by_text(own.n_a), "n_b": own.by_text(own.n_b), "n_groups": own.by_text(own.groups), "n_links": own.by_text(own.links), "n_best": total(2), "count_sum": total(1), "row": row + np.arange(b.num_rows)}
            columns = {"doc_id": b.column("doc_id")} | {c: pa.array(v, pa.int64()) for c, v in numbers.items()} | {name: pa.array(said, pa.string())}
            columns["rare"] = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(b.num_rows + 1)), pa.int32()), found)
            yield pa.RecordBatch.from_pydict(columns)
            row += b.num_rows

    summed = docs.mapInArrow(run, f"doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, row long, {name} string, rare array<struct<pair:bigint,times:bigint>>")
    if counts.count() <= popular:
        return summed.select(*result)
    summed = stash(summed, "summed")
    rest = counts.join(F.broadcast(hot.select("pair")), "pair", "left_anti")
    more = summed.select("row", F.explode("rare").alias("r")).select("row", "r.*").join(rest, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("count")).alias("_c"), F.sum(F.col("times") * F.col("best")).alias("_b"))
    whole = summed.join(more, "row", "left")
    return whole.withColumns({"count_sum": F.col("count_sum") + F.coalesce("_c", F.lit(0)), "n_best": F.col("n_best") + F.coalesce("_b", F.lit(0))}).select(*result)
