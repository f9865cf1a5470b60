"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words. Each passage is encoded by the mean of
learned vectors of its words, pairs of words and words' first and last letters (hashed), and by
signals of its writing (letter cases, marks, repetition, lengths); gated attention weighs the
passages, and the weighted mean is scored; only the document's label is learned from (Ilse et
al., 2018). The model is fitted in numpy on a bounded sample of labelled rows and is a megabyte;
every passage of every document is scored.

Edge cases: a null or empty text is one passage without words; without labelled rows of both
classes every score is 1.0 if no row is labelled or the only class is 1, else 0.0; repeated
rows get equal scores; a null doc_id is kept and not held out; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetgraph.llm.common import keep_where, split_batches, text_bytes
from sheetgraph.llm.labelled import sample

PASSAGE = 64
_UPPER = bytes(range(65, 91))
_DIGIT = b"0123456789"
_HIGH = bytes(range(128, 256))
_MARKS = b"%$&*#@^~=<>+_\\{}[]"
N_SIGNALS = 16


def signals(text: bytes) -> np.ndarray:
    """A row of signals for each passage of a text; one row for a text without words."""
    words = text.split()
    if not words:
        out = np.zeros((1, N_SIGNALS), np.float32)
        out[0, 0] = 1
        return out
    spread = len(set(words)) / len(words)
    rows = []
    for at in range(0, len(words), PASSAGE):
        own = words[at : at + PASSAGE]
        m, joined = len(own), b" ".join(own)
        n = len(joined)
        without = n - len(joined.translate(None, _MARKS))
        rows.append(
            (
                0.0,
                m / PASSAGE,
                (n - m + 1) / m / 10,
                (n - len(joined.translate(None, _UPPER))) / n,
                joined.count(b"!") / m,
                joined.count(b"|") / m,
                without / m,
                (n - len(joined.translate(None, _DIGIT))) / n,
                joined.count(b".") / m,
                joined.count(b",") / m,
                (n - len(joined.translate(None, _HIGH))) / n,
                len(set(own)) / m,
                sum(map(eq, own, own[1:])) / m,
                max(map(len, own)) / 50,
                spread,
                (joined.count(b"http") + joined.count(b"@")) / m,
            )
        )
    return np.array(rows, np.float32)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Buckets of each of the four kinds of n-grams: words, pairs of words, first and last three letters of words.
BUCKETS, KINDS = 8192, 4
_P = np.uint64(0x100000001B3)
#: Bytes that are hashed at once: a chunk of whole passages, or a part of a word longer than that.
CHUNK = 1 << 18


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    """The powers of an odd number and of its inverse modulo 2^64, for one chunk."""
    inverse = np.uint64(pow(int(_P), -1, 1 << 64))
    base = np.stack([np.full(CHUNK + 1, _P), np.full(CHUNK + 1, inverse)])
    base[:, 0] = 1
    return np.multiply.accumulate(base, axis=1)


def _long_hash(part: np.ndarray) -> np.uint64:
    """The same hash of bytes of any number, part by part."""
    out, power = 0, 1
    for at in range(0, len(part), CHUNK):
        own = _LOWER[part[at : at + CHUNK]].astype(np.uint64)
        out += power * int((own * _powers()[0, : len(own)]).sum(dtype=np.uint64))
        power = power * int(_powers()[0, CHUNK]) % (1 << 64)
    return np.uint64(out % (1 << 64))


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all passages, one passage after another; the number in each passage; each text's number of passages.

    A text without words is one passage without n-grams. Hashes come from prefix sums over a chunk of passages at a time, so
    beside the words' places, only a chunk's numbers are held.
    """
    joined = b" ".join([*texts, b""])
    if not texts:
        return np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.frombuffer(joined, np.uint8)
    space = _SPACE[raw]
    start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    end = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    text_end = np.cumsum([len(t) + 1 for t in texts])
    n_words = np.diff(np.concatenate([[0], np.searchsorted(start, text_end)]))
    passages = np.maximum(1, -(-n_words // PASSAGE))
    nth = np.arange(len(start)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
    of = np.repeat(np.cumsum(passages) - passages, n_words) + nth // PASSAGE
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)  # each passage's first word
    last = np.concatenate([first[1:], [len(of)]])
    ids, counts = [], np.zeros(int(passages.sum()), np.int64)
    k = 0
    while k < len(first):  # passages k to m - 1 are a chunk; one too long for it is alone
        m = max(k + 1, int(np.searchsorted(end[last - 1], start[first[k]] + CHUNK, side="right")))
        words = slice(int(first[k]), int(last[m - 1]))
        own, n = _chunk(raw, start[words], end[words], of[words])
        ids.append(own)
        counts[of[first[k]] : of[first[m - 1]] + 1] = n  # passages without words between them have none
        k = m
    return np.concatenate(ids) if ids else np.zeros(0, np.uint16), counts, passages


def _chunk(raw: np.ndarray, start: np.ndarray, end: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a chunk's passages, and how many each has."""
    left = int(start[0])
    if int(end[-1]) - left <= CHUNK:
        text = raw[left : int(end[-1])]
        powers = _powers()
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_LOWER[text].astype(np.uint64) * powers[0, : len(text)], dtype=np.uint64)])
        hashed = lambda a, b: (sums[b - left] - sums[a - left]) * powers[1, a - left]
    else:
        hashed = lambda a, b: np.array([_long_hash(raw[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)], np.uint64)
    word = hashed(start, end)
    follows = np.flatnonzero(of[1:] == of[:-1]) + 1
    pair = word[follows - 1] * np.uint64(0x9E3779B97F4A7C15) + word[follows]
    kinds = [(word, of), (pair, of[follows]), (hashed(start, np.minimum(start + 3, end)), of), (hashed(np.maximum(end - 3, start), end), of)]
    ids = np.concatenate([((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(51)).astype(np.uint16) + np.uint16(k * BUCKETS) for k, (h, _) in enumerate(kinds)])
    place = np.concatenate([p for _, p in kinds]) - of[0]
    order = np.argsort(place, kind="stable")
    return ids[order], np.bincount(place, minlength=int(of[-1] - of[0]) + 1)


def bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The signals and n-grams of all passages, the number of n-grams of each, and each text's number of passages."""
    rows = [signals(t) for t in texts]
    return np.concatenate(rows) if rows else np.zeros((0, N_SIGNALS), np.float32), *grams(texts)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _means(table: np.ndarray, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The mean of the table's rows of each passage's n-grams; zero for a passage without any."""
    out = np.zeros((len(n), table.shape[1]), table.dtype)
    some, edge = np.flatnonzero(n > 0), np.cumsum(n) - n
    for lo in range(0, len(some), 2048):
        own = some[lo : lo + 2048]
        a, b = edge[own[0]], edge[own[-1]] + n[own[-1]]
        out[own] = np.add.reduceat(table.take(ids[a:b], 0), edge[own] - a, axis=0) / n[own][:, None]
    return out


class AttentionMIL:
    """Passages as the mean of learned n-gram vectors beside their signals, weighed by gated attention."""

    def __init__(self, dim: int = 8, hidden: int = 24, gate: int = 12, seed: int = 3, attention: bool = True):
        rng = np.random.default_rng(seed)
        inputs = N_SIGNALS + dim
        r = lambda *shape: rng.standard_normal(shape) / np.sqrt(shape[0])
        self.attention = attention
        self.mean, self.scale = np.zeros(N_SIGNALS), np.ones(N_SIGNALS)
        self.table = (rng.standard_normal((KINDS * BUCKETS, dim)) * 0.1).astype(np.float32)
        self.p = {"w": r(inputs, hidden), "b": np.zeros(hidden), "v": r(hidden, gate), "u": r(hidden, gate), "a": r(gate), "c": r(hidden), "d": np.zeros(1)}

    def inputs(self, x: np.ndarray, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.concatenate([(x - self.mean) / self.scale, GAIN * _means(self.table, ids, n)], axis=1)

    def _forward(self, x: np.ndarray, counts: np.ndarray):
        p, edge = self.p, np.cumsum(counts) - counts
        h = np.tanh(x @ p["w"] + p["b"])
        tv, su = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = (tv * su) @ p["a"] * self.attention
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, edge), counts))
        att = e / np.repeat(np.add.reduceat(e, edge), counts)
        z = np.add.reduceat(att[:, None] * h, edge, axis=0)
        return h, tv, su, att, z, z @ p["c"] + p["d"][0]

    def _backward(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the parameters and of the inputs."""
        p, first = self.p, np.cumsum(counts) - counts
        h, tv, su, att, z, logit = self._forward(x, counts)
        dl = (_sigmoid(logit) - y) / len(y)
        g = {"c": z.T @ dl, "d": np.array([dl.sum()])}
        dz = np.repeat(dl[:, None] * p["c"], counts, axis=0)
        datt = (dz * h).sum(axis=1)
        de = self.attention * att * (datt - np.repeat(np.add.reduceat(att * datt, first), counts))
        g["a"] = (tv * su).T @ de
        dt, ds = de[:, None] * p["a"] * su * (1 - tv**2), de[:, None] * p["a"] * tv * su * (1 - su)
        g["v"], g["u"] = h.T @ dt, h.T @ ds
        dh = (att[:, None] * dz + dt @ p["v"].T + ds @ p["u"].T) * (1 - h**2)
        g["w"], g["b"] = x.T @ dh, dh.sum(axis=0)
        return g, dh @ p["w"].T

    def logits(self, x: np.ndarray, ids: np.ndarray, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self._forward(self.inputs(x, ids, n), counts)[-1]

    def fit(self, x: np.ndarray, ids: np.ndarray, n: np.ndarray, counts: np.ndarray, y: np.ndarray, together: int = 5, after: int = 30, batch: int = 256, rate: float = 0.01, decay: float = 1e-4, seed: int = 4) -> "AttentionMIL":
        """Some epochs over everything, n-gram vectors included, then some more with these held."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        rng, edge, at = np.random.default_rng(seed), np.cumsum(counts) - counts, np.cumsum(n) - n
        steps = {k: _Adam(v.shape) for k, v in self.p.items()}
        table_step, fixed = _Adam(self.table.shape, np.float32), None
        for epoch in range(together + after):
            if epoch == together:
                fixed = self.inputs(x, ids, n)
            order = rng.permutation(len(counts))
            for lo in range(0, len(order), batch):
                own = order[lo : lo + batch]
                rows = _spans(edge[own], counts[own])
                if fixed is None:
                    part = ids[_spans(at[rows], n[rows])]
                    z = self.inputs(x[rows], part, n[rows])
                else:
                    z = fixed[rows]
                g, dx = self._backward(z, counts[own], y[own])
                r = rate * 0.5 ** (epoch / 15)
                for k, v in self.p.items():
                    v -= r * steps[k](g[k] + decay * v)
                if fixed is None:
                    each = GAIN * dx[:, N_SIGNALS:] / np.maximum(n[rows], 1)[:, None]
                    grad = np.stack([np.bincount(part, np.repeat(c, n[rows]), len(self.table)) for c in each.T], axis=1).astype(np.float32)
                    self.table -= np.float32(r) * table_step(grad + np.float32(decay) * self.table)
        return self


#: The mean of many small vectors is small; this brings it to the size of the signals.
GAIN = 4.0


class _Adam:
    def __init__(self, shape: tuple, kind=np.float64):
        self.one, self.two, self.n = np.zeros(shape, kind), np.zeros(shape, kind), 0

    def __call__(self, g: np.ndarray) -> np.ndarray:
        self.n += 1
        self.one += 0.1 * (g - self.one)
        self.two += 0.001 * (g * g - self.two)
        return (self.one / (1 - 0.9**self.n)) / (np.sqrt(self.two / (1 - 0.999**self.n)) + 1e-8)


def _spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places first .. first + n - 1 of each, one after another."""
    return np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)


def train(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", most: int = 5000, passages: int = 32, attention: bool = True) -> AttentionMIL | float:
    """The fitted model, or the constant score where the labels do not hold both classes.

    Of a sampled text up to `passages` passages, evenly spread over it, are learned from.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in split_batches(batches, 512):
            x, ids, n, counts = bags(text_bytes(b.column("text")))
            edge, at = np.cumsum(counts) - counts, np.cumsum(n) - n
            own = [e + np.unique(np.linspace(0, c - 1, min(c, passages)).astype(np.int64)) for e, c in zip(edge, counts, strict=True)]
            pack = lambda rows: (x[rows].astype("<f4").tobytes(), ids[_spans(at[rows], n[rows])].astype("<u2").tobytes(), n[rows].astype("<i4").tobytes())
            packed = list(zip(*map(pack, own), strict=True))
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("y"), *(pa.array(c, pa.binary()) for c in packed)], ["_id", "y", "x", "ids", "n"])

    got = sample(docs, labels, label, held_out, most).mapInArrow(run, "_id long, y int, x binary, ids binary, n binary").toArrow().sort_by("_id")
    y = got.column("y").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return float(y.max()) if len(y) else 1.0
    joined = lambda c, kind: np.frombuffer(b"".join(got.column(c).to_pylist()), kind)
    n = joined("n", "<i4").astype(np.int64)
    counts = np.array([len(v) // 4 for v in got.column("n").to_pylist()], np.int64)
    return AttentionMIL(attention=attention).fit(joined("x", "<f4").reshape(-1, N_SIGNALS).astype(float), joined("ids", "<u2"), n, counts, y)


def rate(model: AttentionMIL | float, texts: list[bytes]) -> np.ndarray:
    """The score of each text."""
    if isinstance(model, float):
        return np.full(len(texts), model)
    return _sigmoid(model.logits(*bags(texts))) if texts else np.zeros(0)


def score(docs: DataFrame, model: AttentionMIL | float, threshold: float = 0.7) -> DataFrame:
    """doc_id, score and predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in split_batches(batches, 512):
            s = rate(model, text_bytes(b.column("text")))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "score": pa.array(s, pa.float64()), "predicted": pa.array((s >= threshold).astype(np.int32))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: AttentionMIL | float, threshold: float = 0.7) -> DataFrame:
    """docs without the rows whose score is below the threshold."""
    return keep_where(docs, lambda: lambda column: rate(model, text_bytes(column)) >= threshold)
