"""LM scoring: a log-bilinear neural model trained in numpy with noise-contrastive estimation.

From the vectors of the two words before it, the model predicts a word's class, then its item
in the class. The 64 most frequent words and the end are classes of their own, the others share
one by their first two letters (80 prefixes and a rest); the 4096 most frequent words are items,
the rest of each shared class is one more. A word is drawn from its item by its count, so
    log p(w | h) = log p(w) + log p(item(w) | h) - log p(item(w)),
where p(w) is the count base and p(item | h) a product of two softmaxes: matrix products of a
batch, normalised. The rest of each shared class holds an unseen word of its own. Words beyond the 4096 thus get
their class and "a rare word of it" from context, and the word itself from its count.

Counts cover every training token: each task counts its own words, the counts are added in a
shuffle. Training covers every training token too (see train). The `head` most frequent words
are held by each worker; counts of all other words are joined.

Edge cases: a null text counts as empty (its end is one token); a null doc_id is not held
out, and its row is dealt to a learner by its place; repeated rows are scored and counted each; without training rows N and V are 0 and all
scores follow from the unseen word alone; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetgraph.llm.common import split_batches, stash


def words_of(text: bytes) -> list[bytes]:
    """Words of a text after lower-casing A-Z: bytes.split() cuts at 0x20 and 0x09-0x0D alone."""
    return text.lower().split()


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, and the number of each, as words_of() has them; null counts as empty."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten()
    some = pc.not_equal(flat, "")  # white space at an end leaves an empty part
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return flat.filter(some), np.diff(before[offsets])


def count_words(docs: DataFrame, flush: int = 300_000) -> DataFrame:
    """word and c over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in split_batches(batches, 512):
            flat = pc.value_counts(split(b.column("text"))[0])
            held.append(pa.table([flat.field("values"), flat.field("counts")], ["word", "c"]))
            size += len(flat)
            if size > 2 * flush:
                held = [pa.concat_tables(held).group_by("word").aggregate([("c", "sum")]).rename_columns(["word", "c"])]
                size = held[0].num_rows
                if size > flush:
                    yield from held.pop().to_batches()
                    size = 0
        if held:
            yield from pa.concat_tables(held).group_by("word").aggregate([("c", "sum")]).rename_columns(["word", "c"]).to_batches()

    return docs.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Shape:
    """What the counts fix: head words, classes, items and their weights.

    Items are the `own` most frequent words, then the rest of each shared class, then the end;
    each has an input and an output vector. A word's code is its rank, the end's comes next,
    then one for the words of each shared class beyond the head.
    """

    n: int
    v: int
    words: list[bytes]  # head, most frequent first
    log_p: np.ndarray  # of head words, then of the end
    single: int  # the first words are classes of their own, then comes the end
    prefixes: dict[str, int]  # first two letters -> number among the shared classes
    own: int
    weight: np.ndarray  # of each item: the sum of c + 0.5 over its words, and 0.5 for an unseen one

    @property
    def shared(self) -> int:
        return len(self.prefixes) + 1

    @property
    def total(self) -> float:
        return self.n + 0.5 * (self.v + 1)

    @property
    def start(self) -> int:
        """The input before a text's first token."""
        return len(self.weight)

    def _share(self, words: list[bytes]) -> np.ndarray:
        return np.array([self.prefixes.get(w.decode()[:2], self.shared - 1) for w in words], np.int32)

    def item_of_code(self) -> np.ndarray:
        return np.concatenate([np.arange(self.own), self.own + self._share(self.words[self.own :]), [self.own + self.shared], self.own + np.arange(self.shared)]).astype(np.int32)

    def class_of_item(self) -> np.ndarray:
        return np.concatenate([np.arange(self.single), self.single + 1 + self._share(self.words[self.single : self.own]), self.single + 1 + np.arange(self.shared), [self.single]]).astype(np.int32)


def shape(counts: DataFrame, n_docs: int, head: int = 65_000, single: int = 64, prefixes: int = 80, own: int = 4096) -> Shape:
    """At most head words and `prefixes` sums come to the driver, whatever the size of the vocabulary."""
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = int(total["n"] or 0) + n_docs, int(total["v"]) + (1 if n_docs else 0)
    top = counts.orderBy(F.desc("c"), "word").limit(head).toArrow()
    words = [w.encode() for w in top.column("word").to_pylist()]
    c = top.column("c").to_numpy().astype(float)
    d = n + 0.5 * (v + 1)
    own = min(own, len(words))
    single = min(single, own)
    by = counts.groupBy(F.substring("word", 1, 2).alias("p")).agg((F.sum("c") + 0.5 * F.count("*")).alias("m")).orderBy(F.desc("m"), "p").limit(prefixes).collect()
    mass = np.array([r["m"] for r in by] + [0.0])
    mass[-1] = max(n - n_docs + 0.5 * (v - (1 if n_docs else 0)) - mass.sum(), 0.0)
    out = Shape(n, v, words, np.log10(np.concatenate([c + 0.5, [n_docs + 0.5]]) / d), single, {r["p"]: k for k, r in enumerate(by)}, own, np.zeros(0))
    mass -= np.bincount(out._share(words[:own]), c[:own] + 0.5, len(mass))
    out.weight = np.concatenate([c[:own] + 0.5, np.maximum(mass, 0.0) + 0.5, [n_docs + 0.5]])
    return out


class Coder:
    """Codes of words."""

    def __init__(self, s: Shape):
        self._words, self._prefixes = pa.array([w.decode() for w in s.words], pa.string()), pa.array(list(s.prefixes), pa.string())
        self._base, self._other = len(s.words) + 1, s.shared - 1

    def __call__(self, flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """The code of each word, and the words beyond the head."""
        found = pc.index_in(flat, value_set=self._words)
        codes = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).copy()
        rare = flat.filter(pc.is_null(found))
        codes[codes < 0] = self._base + pc.fill_null(pc.index_in(pc.utf8_slice_codeunits(rare, 0, 2), value_set=self._prefixes), self._other).to_numpy(zero_copy_only=False)
        return codes, rare


def contexts(ids: np.ndarray, counts: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The inputs one and two places before each token, `start` before a text's first."""
    first = np.cumsum(counts) - counts
    one, two = np.empty_like(ids), np.empty_like(ids)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    one[first] = start
    two[first] = start
    second = first[counts > 1] + 1
    two[second] = start
    return one, two


class LogBilinear:
    """p(item | h) = p(class | h) p(item | class, h): two softmaxes over products with the same context vector h."""

    def __init__(self, weight: np.ndarray, class_of: np.ndarray, dim: int = 24, seed: int = 11):
        rng = np.random.default_rng(seed)
        near_zero = lambda n: (rng.standard_normal((n, dim)) * 0.1).astype(np.float32)
        self.class_of = class_of
        self.mass = np.bincount(class_of, weight)
        self.mass /= self.mass.sum()
        order = np.argsort(class_of, kind="stable")
        size = np.bincount(class_of)
        self.members = np.split(order, np.cumsum(size)[:-1])
        self.place = np.empty(len(order), np.int64)  # of an item among its class's
        self.place[order] = np.arange(len(order)) - np.repeat(np.cumsum(size) - size, size)
        self.multi = size > 1
        within = np.where(self.multi[class_of], weight, 0.0)
        self.within = within / max(within.sum(), 1e-300)
        self.q, self.b = near_zero(len(size)), np.log(self.mass).astype(np.float32)
        self.r = near_zero(len(weight) + 1)
        self.c = np.stack([np.ones(dim), np.full(dim, 0.5)]).astype(np.float32)
        self.u, self.a = near_zero(len(weight)), np.log(np.maximum(self.within, 1e-30)).astype(np.float32)
        self.g = [np.full_like(x, 1e-3) for x in self._all()]  # AdaGrad's sums of squares

    def _all(self) -> list[np.ndarray]:
        return [self.q, self.b, self.r, self.c, self.u, self.a]

    def params(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (*self._all(), *self.g)])

    def load(self, flat: np.ndarray) -> "LogBilinear":
        at = 0
        for x in (*self._all(), *self.g):
            x.ravel()[:] = flat[at : at + x.size]
            at += x.size
        return self

    def context(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.r.take(one, 0) * self.c[0] + self.r.take(two, 0) * self.c[1]

    def log_probs(self, one: np.ndarray, two: np.ndarray, item: np.ndarray, batch: int = 1024, chunk: int = 32_768) -> np.ndarray:
        """Normalised natural log p(item | one, two)."""
        out, qt, ut = np.empty(len(item)), np.ascontiguousarray(self.q.T), [np.ascontiguousarray(self.u[m].T) for m in self.members]
        for at in range(0, len(item), chunk):
            own = item[at : at + chunk]
            h, y = self.context(one[at : at + chunk], two[at : at + chunk]), self.class_of[own].astype(np.int16)
            got = np.empty(len(own))
            for lo in range(0, len(own), batch):
                got[lo : lo + batch] = _log_softmax(h[lo : lo + batch], qt, self.b, y[lo : lo + batch])
            order = np.argsort(y, kind="stable")
            edge = np.searchsorted(y[order], np.arange(len(self.b) + 1))
            for k in np.flatnonzero(self.multi & (np.diff(edge) > 0)).tolist():
                for lo in range(edge[k], edge[k + 1], batch):
                    rows = order[lo : min(lo + batch, edge[k + 1])]
                    got[rows] += _log_softmax(h.take(rows, 0), ut[k], self.a[self.members[k]], self.place[own[rows]])
            out[at : at + chunk] = got
        return out


def _log_softmax(h: np.ndarray, wt: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = h @ wt
    z += b
    if z.max() > 80:
        z -= z.max(axis=1, keepdims=True)
    true = z[np.arange(len(z)), y].astype(np.float64)
    return true - np.log(np.exp(z, out=z) @ np.ones(len(b), np.float32))


class Trainer:
    """Noise-contrastive estimation with AdaGrad; the noise of a batch is shared by its tokens.

    Classes are told from noise classes for each token, items from noise items for the tokens
    of shared classes.
    """

    def __init__(self, model: LogBilinear, noise: tuple[int, int] = (64, 160), rate: float = 0.1, seed: int | list[int] = 0):
        self.m, self.noise, self.rate = model, noise, rate
        self.rng = np.random.default_rng([17, *np.atleast_1d(seed).tolist()])
        self.edges = [np.cumsum(x) for x in (model.mass, model.within)]
        self.log_kq = [np.log(np.maximum(x, 1e-30) * k).astype(np.float32) for x, k in zip((model.mass, model.within), noise, strict=True)]

    def _tell(self, which: int, h: np.ndarray, y: np.ndarray, w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradients of the contexts, the vectors and the offsets."""
        edge, log_kq = self.edges[which], self.log_kq[which]
        x = np.minimum(np.searchsorted(edge, self.rng.random(self.noise[which]) * edge[-1], side="right"), len(edge) - 1)
        wy, wx = w.take(y, 0), w[x]
        true, z = np.einsum("ij,ij->i", h, wy) + (b - log_kq)[y], h @ wx.T
        z += (b - log_kq)[x]
        with np.errstate(over="ignore"):  # exp may be infinite: the quotient is 0 then
            gp = 1 / (1 + np.exp(true))
            np.negative(z, out=z)
            np.exp(z, out=z)
            z += 1
            gn = np.reciprocal(z, out=z)
        dw = _sums(y, gp[:, None] * h, len(w))
        np.subtract.at(dw, x, gn.T @ h)
        return gp[:, None] * wy - gn @ wx, dw, np.bincount(y, gp, len(b)) - np.bincount(x, gn.sum(axis=0), len(b))

    def step(self, one: np.ndarray, two: np.ndarray, item: np.ndarray) -> None:
        m = self.m
        r1, r2, y = m.r.take(one, 0), m.r.take(two, 0), m.class_of[item]
        h = r1 * m.c[0] + r2 * m.c[1]
        dh, dq, db = self._tell(0, h, y, m.q, m.b)
        du, da = np.zeros_like(m.u), np.zeros_like(m.a)
        some = np.flatnonzero(m.multi[y])
        if len(some):
            more, du, da = self._tell(1, h[some], item[some], m.u, m.a)
            dh[some] += more
        dr = _sums(np.concatenate([one, two]), np.concatenate([dh * m.c[0], dh * m.c[1]]), len(m.r))
        dc = np.stack([np.einsum("ij,ij->j", dh, r1), np.einsum("ij,ij->j", dh, r2)])
        for p, g, d in zip(m._all(), m.g, (dq, db, dr, dc, du, da), strict=True):
            d = d.astype(np.float32, copy=False)
            d *= np.float32(1 / math.sqrt(len(item)))
            g += d * d
            d *= np.float32(self.rate)
            d /= np.sqrt(g)
            p += d

    def feed(self, one: np.ndarray, two: np.ndarray, item: np.ndarray, batch: int = 2048) -> None:
        for lo in range(0, len(item), batch):
            self.step(one[lo : lo + batch], two[lo : lo + batch], item[lo : lo + batch])


def _sums(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows with each index."""
    out, dim = np.zeros((n, rows.shape[1]), np.float32), rows.shape[1]
    np.add.at(out.ravel(), (index.astype(np.int64)[:, None] * dim + np.arange(dim)).ravel(), rows.ravel())
    return out


def _addition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of parts, weighted by their tokens."""
    held: dict[tuple[int, int], tuple[float, np.ndarray]] = {}
    for b in split_batches(batches, 64):
        for part, salt, tokens, mean in zip(*(b.column(c).to_pylist() for c in ("part", "salt", "tokens", "mean")), strict=True):
            t, x = held.get((part, salt), (0.0, 0.0))
            held[part, salt] = t + tokens, x + tokens * np.frombuffer(mean, "<f4").astype(float)
    for (part, salt), (tokens, sums) in held.items():
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "salt": pa.array([salt], pa.int32()), "tokens": pa.array([tokens]), "mean": pa.array([(sums / tokens).astype("<f4").tobytes()], pa.binary())})


def train(coded: DataFrame, s: Shape, dim: int = 24, rounds: int = 4, share: int = 2_000_000, most: int = 4096, chunk: int = 16_384) -> LogBilinear:
    """The model after `rounds` rounds; coded has n_tokens, codes and deal, a hash of the row.

    Rows are dealt by that hash to learners of about `share` tokens each (beyond `most` learners
    their shares grow) and to the rounds, so no result depends on files or partitions. In a
    round each learner goes on from the last average with its rows of that round; parameters and
    AdaGrad's sums are averaged, weighted by tokens. Every row is learned from once.
    """
    model = LogBilinear(s.weight, s.class_of_item(), dim)
    item_of, tokens = s.item_of_code(), int(coded.agg(F.sum("n_tokens")).first()[0] or 0)
    learners = max(1, min(most, round(tokens / share)))
    dealt = coded.select(F.pmod("deal", F.lit(learners)).cast("int").alias("learner"), F.pmod(F.shiftright("deal", 32), F.lit(rounds)).cast("int").alias("round"), "deal", "n_tokens", "codes")
    kind = "part int, salt int, tokens double, mean binary"
    size = len(model.params())

    def run_from(state: np.ndarray, number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, trainer, seen, held = None, None, 0, []

            def feed(last: bool) -> None:
                nonlocal held, seen
                rows = [np.concatenate(x) for x in zip(*held, strict=True)]
                whole = len(rows[0]) if last else len(rows[0]) // 65_536 * 65_536
                trainer.feed(*(x[:whole] for x in rows))
                seen, held = seen + whole, [tuple(x[whole:] for x in rows)]

            def done() -> pa.RecordBatch:
                feed(True)
                flat = trainer.m.params().astype("<f4")
                parts = range(0, size, chunk)
                return pa.RecordBatch.from_pydict({"part": pa.array([p // chunk for p in parts], pa.int32()), "salt": pa.array([now % 32] * len(parts), pa.int32()), "tokens": pa.array([float(seen)] * len(parts)), "mean": pa.array([flat[p : p + chunk].tobytes() for p in parts], pa.binary())})

            for b in split_batches(batches, 256):
                own = b.column("learner").to_numpy()
                edge = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
                for lo, hi in zip(edge, edge[1:], strict=False):
                    if own[lo] != now:
                        if now is not None:
                            yield done()
                        now, seen, held = int(own[lo]), 0, []
                        trainer = Trainer(LogBilinear(s.weight, s.class_of_item(), dim).load(state), seed=[now, number])
                    item = item_of[np.frombuffer(b"".join(b.column("codes").slice(lo, hi - lo).to_pylist()), "<u2")]
                    held.append((*contexts(item, b.column("n_tokens").slice(lo, hi - lo).to_numpy(), s.start), item))
                    if sum(len(x[0]) for x in held) >= 131_072:
                        feed(False)
            if now is not None:
                yield done()

        return run

    for k in range(rounds if tokens else 0):
        own = dealt.where(F.col("round") == k).drop("round").repartition(learners, "learner").sortWithinPartitions("learner", "deal", "n_tokens", "codes")
        local = own.select("learner", "n_tokens", "codes").mapInArrow(run_from(model.params(), k), kind)
        first = local.repartition("part", "salt").mapInArrow(_addition, kind).withColumn("salt", F.lit(0))
        rows = sorted(first.repartition("part").mapInArrow(_addition, kind).collect(), key=lambda r: r["part"])
        if rows:  # a small table may have no row in a round
            model.load(np.concatenate([np.frombuffer(r["mean"], "<f4") for r in rows]))
    return model


def codes_of(rows: DataFrame, s: Shape) -> DataFrame:
    """Each row's codes, and its words beyond the head; the text is split into words once for training and scoring."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, at, end = Coder(s), TaskContext.get().partitionId() << 33, len(s.words)
        log_p = np.concatenate([s.log_p, np.zeros(s.shared)])
        for b in split_batches(batches, 512):
            flat, n = split(b.column("text"))
            codes, rare = coder(flat)
            ends = np.concatenate([[0], np.cumsum(n)])
            offsets = np.concatenate([[0], np.cumsum(codes > end)])[ends]
            codes, n = np.insert(codes, ends[1:], end), n + 1
            edge = np.cumsum(n) - n
            wide = codes.astype("<u2")
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.array(at + np.arange(len(n))),
                    "doc_id": b.column("doc_id"),
                    "held_out": b.column("held_out"),
                    "deal": b.column("deal"),
                    "n_tokens": pa.array(n),
                    "base_part": pa.array(np.add.reduceat(log_p[codes], edge)),
                    "codes": pa.array([wide[e : e + k].tobytes() for e, k in zip(edge.tolist(), n.tolist(), strict=True)], pa.binary()),
                    "tail": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rare),
                }
            )
            at += len(n)

    return rows.mapInArrow(run, "row long, doc_id long, held_out boolean, deal long, n_tokens long, base_part double, codes binary, tail array<string>")


def score(docs: DataFrame, held_out: Column, head: int = 65_000, dim: int = 24) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; held-out rows are not learned from."""
    deal = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.monotonically_increasing_id()), F.crc32("text"))  # copies and rows without an id are spread
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text", deal.alias("deal"))
    taught = rows.where(~F.col("held_out"))
    counts = stash(count_words(taught), "counts")
    s = shape(counts, taught.select("doc_id").count(), head)
    coded = stash(codes_of(rows, s), "codes")
    model = train(coded.where(~F.col("held_out")), s, dim)
    item_of, log_base = s.item_of_code(), np.log(s.weight / s.total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in split_batches(batches, 512):
            n = b.column("n_tokens").to_numpy()
            item = item_of[np.frombuffer(b"".join(b.column("codes").to_pylist()), "<u2")]
            one, two = contexts(item, n, s.start)
            gain = (model.log_probs(one, two, item) - log_base[item]) / math.log(10)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(np.add.reduceat(gain, np.cumsum(n) - n))], [*names, "gain"])

    names = ["row", "doc_id", "held_out", "n_tokens", "base_part"]
    scored = coded.select(*names, "codes").mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, base_part double, gain double")
    tail = coded.select("row", F.explode("tail").alias("word")).join(counts, "word", "left")
    log_c = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / s.total)
    sums = tail.groupBy("row").agg(F.sum(log_c).alias("tail_score"), F.count_if(F.col("c").isNull()).alias("unseen"))
    out = scored.join(sums, "row", "left").withColumn("unseen", F.coalesce("unseen", F.lit(0)))
    end_unseen = 0 if s.n else 1  # without training rows the end is unseen as well
    out = out.withColumn("base_score", F.col("base_part") + F.coalesce("tail_score", F.lit(0.0)))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_tokens") - F.col("unseen") - end_unseen).cast("long").alias("n_known"), F.lit(s.n).cast("long").alias("train_tokens"), "base_score", (F.col("base_score") + F.col("gain")).alias("score"))
