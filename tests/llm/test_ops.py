"""Each operator against a brute-force version, on rows with nulls, empty and long texts, ties, copies and clashing columns."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sheetgraph.llm import bfd_packing, byte_bpe, collision_join, lbl, mil_quality, nnls_packing, rendezvous, simhash, toxic_grammar, vamana
from sheetgraph.llm.wordbpe import WordEncoder

WORDS = P.path("word_bpe_49k.json")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, `_k` int, shard string, vec string, component string"


def texts():
    rng = random.Random(7)
    words = ["the", "Straße", "x.", "año,", "don't", "日本", "42", "\x1c", "é", "foo-bar", "🙂", "H̱", "क़िला", "בּ", "<|endoftext|>", "a<|startoftext|>B", "<|ENDOFTEXT|>"] + [f"w{k}" for k in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [say(rng.randrange(1, 300)) for _ in range(30)]
    return [None, "", "   \n\t ", "one", "one two", say(9000), "a" * 5000, *base, base[0], base[0], base[1] + " tail", base[2].upper()]


@pytest.fixture(scope="module")
def rows():
    t = texts()
    out = [(k, x) for k, x in enumerate(t)]
    return out + [(5, t[5]), (None, "no id"), (None, None), (-3, "one two")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, x, "en", 1, "clash", "clash", "clash") for i, x in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def ids(rows):
    t = Tokenizer.from_file(WORDS)
    return Counter((i, tuple(t.encode(x or "", add_special_tokens=False).ids + [1])) for i, x in rows)


def test_word_encoder_with_a_small_cache(rows):
    t = Tokenizer.from_file(WORDS)
    e = WordEncoder(WORDS, limit=20)
    for _, x in rows:
        assert e.encode((x or "").encode()).tolist() == t.encode(x or "", add_special_tokens=False).ids
    assert len(e._at) == 20


def test_word_encoder_on_every_letter():
    t, e = Tokenizer.from_file(WORDS), WordEncoder(WORDS)
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    for form in ("{0}", "ab{0}", "{0}ab", "X{0}{0}."):
        said = [form.format(c) for c in letters]
        want = t.encode_batch(said, add_special_tokens=False)
        ids, n = e.encode_many([x.encode() for x in said])
        ends = np.cumsum(n)
        assert [x.ids for x in want] == [ids[b - k : b].tolist() for b, k in zip(ends, n, strict=True)]
    assert e.encode(" ".join(["abc", *letters, "xyz"]).encode()).tolist() == t.encode(" ".join(["abc", *letters, "xyz"]), add_special_tokens=False).ids


def test_best_fit_decreasing():
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = rng.integers(1, 33, 60)
        bins, n = bfd_packing.best_fit_decreasing(lengths, 32)
        free: list[int] = []
        for k in np.argsort(-lengths, kind="stable"):  # the plain scan opens as many bins
            fits = [f for f in free if f >= lengths[k]]
            if fits:
                free[free.index(min(fits))] -= lengths[k]
            else:
                free.append(32 - lengths[k])
        assert n == len(free) and sorted(np.bincount(bins, lengths)) == sorted(32 - f for f in free)


def _rebuilt(pieces):
    """Documents from pieces (doc_id, start, ids): copies of a doc_id may not be told apart, so ids are compared as a whole."""
    return Counter((d, i) for d, _, own in pieces for i in own)


def _in_order(pieces, ids):
    """Each document that occurs once is its pieces in order, without a gap or an overlap."""
    for d, own in ids:
        if d in (None, 5):
            continue
        joined = []
        for _, start, part in sorted((p for p in pieces if p[0] == d), key=lambda p: p[1]):
            assert start == len(joined)
            joined += part
        assert tuple(joined) == own


def test_bfd_packing(docs, no_docs, ids):
    rows = bfd_packing.pack(docs, WORDS, window=256, cell_tokens=2000).collect()
    pieces = []
    for r in rows:
        m, p = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(m) == len(p) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and (m[r.n_tokens :] == 0).all()
        for s, a, b in zip(r.segments, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert b - a == s.length and (p[a:b] == np.arange(b - a)).all()
            pieces.append((s.doc_id, s.start, m[a:b].tolist()))
    assert _rebuilt(pieces) == Counter((d, i) for (d, own), n in ids.items() for i in own for _ in range(n))
    _in_order(pieces, ids)
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert bfd_packing.pack(no_docs, WORDS).count() == 0


def test_nnls():
    rng = np.random.default_rng(2)
    for _ in range(10):
        a, b = rng.random((8, 15)), rng.random(8)
        x = nnls_packing.nnls(a, b)
        g = a.T @ (a @ x - b)
        assert (x >= 0).all() and (g > -1e-6).all() and abs(g[x > 0]).max(initial=0) < 1e-6  # optimality
    assert all(r @ np.arange(9) == 8 for r in nnls_packing.combinations(8, 3))


def test_nnls_packing(docs, no_docs, ids):
    rows = nnls_packing.pack(docs, WORDS, window=256, unit=8, cell_tokens=2000, with_ids=True).collect()
    assert _rebuilt((r.doc_id, r.start, r.ids) for r in rows) == Counter((d, i) for (d, own), n in ids.items() for i in own for _ in range(n))
    by, padding, total = {}, 0, 0
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length > 0
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
        total += at
        padding += 0 if at & (at - 1) == 0 else 256 - at
    assert padding < 0.04 * total
    _in_order([(r.doc_id, r.start, r.ids) for r in rows], ids)
    assert all(r.doc_tokens == len(next(own for (d, own) in ids if d == r.doc_id)) for r in rows if r.doc_id not in (None, 5))
    assert nnls_packing.pack(no_docs, WORDS).count() == 0


def _shard(spark, key, n):
    return spark.createDataFrame([(k,) for k in key], "k string").select(rendezvous.shard_of(F.col("k"), n).alias("s"))


def test_rendezvous(spark, docs, no_docs, rows):
    out = rendezvous.number(rendezvous.assign(docs, "doc_id", [1.0] * 8, [1.0] * 9), "doc_id").collect()
    assert len(out) == len(rows) and all(r.grown_shard in (r.shard, 8) for r in out)
    for s in range(8):
        own = sorted(r.slot for r in out if r.shard == s)
        assert own == list(range(len(own)))
    assert len({r.shard for r in out if r.doc_id is None}) == 1 == len({r.shard for r in out if r.doc_id == 5})
    assert rendezvous.number(rendezvous.assign(no_docs, "doc_id", [1.0] * 8), "doc_id").count() == 0
    many = [f"k{k}" for k in range(6000)]
    counts = Counter(r.s for r in _shard(spark, many, [1.0, 2.0, 1.0]).collect())
    assert abs(counts[1] / 6000 - 0.5) < 0.03 and abs(counts[0] - counts[2]) < 250
    hot = spark.range(3000).select(F.lit(1).alias("doc_id"))  # one key is one shard, but many buckets
    got = rendezvous.number(rendezvous.assign(hot, "doc_id", [1.0] * 4), "doc_id").agg(F.min("slot"), F.max("slot"), F.count_distinct("slot"), F.count_distinct("shard")).first()
    assert tuple(got) == (0, 2999, 3000, 1)


def test_byte_bpe(docs, no_docs, rows):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter()
    for i, x in rows:
        own = np.array(enc.encode_ordinary(x or ""), "<u4").tobytes()
        expected[i, len(own) // 4, hashlib.sha256(own).hexdigest(), hashlib.sha256((x or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in byte_bpe.encode(docs, RANKS, P.PATTERN, digests=True).collect()) == expected
    back = byte_bpe.decode(byte_bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert Counter(map(tuple, back.collect())) == Counter((i, x or "") for i, x in rows)
    assert byte_bpe.encode(no_docs, RANKS, P.PATTERN).count() == 0
    assert byte_bpe.merge(b"a", {b"a": 3}) == [3]


def _fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(values, linked):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in values:
        for b in values:
            if a < b and linked(a, b) and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_simhash(spark, docs, no_docs, rows):
    got = simhash.cluster(docs).collect()
    fps = [_fingerprint(x) for _, x in rows]
    root = _classes(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 2)
    low = {}
    for (i, _), f in zip(rows, fps, strict=True):
        if i is not None:
            low[root[f]] = min(low.get(root[f], i), i)
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == Counter((i, f, low.get(root[f])) for (i, _), f in zip(rows, fps, strict=True))
    assert simhash.cluster(no_docs).count() == 0


def test_close_fingerprints_in_split_buckets(spark):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, 3, dtype=np.uint64)
    flips = lambda n: sum(1 << int(b) for b in rng.choice(64, n, replace=False))
    fps = sorted({int(c) ^ flips(int(rng.integers(0, 4))) for c in centre for _ in range(150)})
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    expected = _classes(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    for most in (1024, 16):
        edges = {(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.links(df, 2, most=most).collect()}
        assert all(expected[a] == expected[b] for a, b in edges)
        assert _classes(fps, lambda a, b: (a, b) in edges or (b, a) in edges) == expected


VEC = "vec_id long, embedding array<float>, label int, id int, n string, vec string"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((260, 16))
    near = [base[k % 6] + 0.1 * rng.standard_normal(16) for k in range(60)]
    out = [(k, [float(np.float32(v)) for v in x], 0, 1, "c", "c") for k, x in enumerate([*base, *near, *[base[9]] * 40])]
    odd = [None, [], [0.0] * 16, [math.nan] * 16, [math.inf] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    out += [(1000 + k, v, 0, 1, "c", "c") for k, v in enumerate(odd)] + [(None, out[0][1], 0, 1, "c", "c"), (9, out[9][1], 0, 1, "c", "c")]
    return out


def _usable(v):
    return v is not None and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_collision_join(spark, vectors):
    df = spark.createDataFrame(vectors, VEC).repartition(3)
    got = collision_join.near_duplicates(df, "vec_id", "embedding", 0.9).collect()
    assert len(got) == len(vectors)
    own = [(i, np.array(v, float) / np.linalg.norm(v)) for i, v, *_ in vectors if i is not None and _usable(v)]
    u = np.stack([x for _, x in own])
    near = u @ u.T >= 0.9
    n = Counter()
    for (i, _), k in zip(own, near.sum(axis=1) - 1, strict=True):
        n[i, int(k)] += 1
    found = Counter((r.vec_id, r.n_links) for r in got if r.vec_id is not None and r.vec_id < 1000)
    assert sum(k * c for (_, k), c in found.items()) >= 0.97 * sum(k * c for (_, k), c in n.items())
    for split in (2048, 8):
        again = collision_join.near_duplicates(df, "vec_id", "embedding", 0.9, most=split).collect()
        assert Counter((r.vec_id, r.n_links, r.component_id) for r in again) == Counter((r.vec_id, r.n_links, r.component_id) for r in got)
    assert all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in got if r.vec_id is not None and r.vec_id >= 1000)
    assert collision_join.near_duplicates(spark.createDataFrame([], VEC), "vec_id", "embedding").count() == 0


def test_vamana(spark, vectors):
    df = spark.createDataFrame(vectors, VEC).repartition(3)
    got = vamana.nearest(df, "vec_id", "embedding", F.col("vec_id") % 10 == 0, k=10, shard=100).collect()
    own = [(i, np.array(v, float)) for i, v, *_ in vectors if i is not None and _usable(v)]
    hit = total = 0
    for q, x in own:
        if q % 10:
            continue
        true = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in own if i != q)[:10]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and all(abs(a[2] - dict(map(reversed, [(d, i) for d, i in sorted(((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in own if i == a[1]))]))[a[1]]) < 1e-9 for a in mine)
        hit += len({m[1] for m in mine} & {i for _, i in true})
        total += 10
    assert hit >= 0.95 * total
    assert vamana.nearest(spark.createDataFrame([], VEC), "vec_id", "embedding", F.col("vec_id") % 10 == 0).count() == 0


def test_language_model(spark, docs, no_docs, rows):
    from sheetgraph.llm.common import fold

    got = lbl.score(docs, fold("doc_id", 5, 1), head=50).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = lambda x: [*lbl.words_of((x or "").encode()), None]
    c = Counter(w for i, x in rows if not held(i) for w in tokens(x))
    n, v = sum(c.values()), len(c)
    base = Counter()
    for i, x in rows:
        w = tokens(x)
        base[i, held(i), len(w), sum(c[k] > 0 for k in w), n, round(sum(math.log10((c[k] + 0.5) / (n + 0.5 * (v + 1))) for k in w), 4)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == base
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lbl.score(no_docs, fold("doc_id", 5, 1)).count() == 0
    everything_held = lbl.score(docs, F.lit(True)).collect()
    assert len(everything_held) == len(rows) and all(r.n_known == 0 and r.train_tokens == 0 for r in everything_held)


def _nearest(own, q, k=10):
    """The k nearest of all, ties to the smaller id."""
    x = next(y for i, y in own if i == q)
    return sorted((float(vamana.euclidean(y[None], x)[0]), i) for i, y in own if i != q)[:k]


@pytest.mark.parametrize("name", ["large", "far", "beside", "spread", "few", "huge"])
def test_vamana_on_odd_places(spark, name):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((600, 24))
    if name == "large":
        x *= 1e20
    elif name == "far":  # a small cloud away from the origin
        x = 100 + 1e-3 * x
    elif name == "beside":  # one vector far from all others
        x[17] = 1e25
    elif name == "spread":
        x = rng.standard_normal((12, 24))[rng.integers(0, 12, 600)] * 1e7 + x
    elif name == "few":
        x = x[:5]
        x[3] = 1e25
    elif name == "huge":
        x *= 1e306
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    got = vamana.nearest(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, shard=300).orderBy("query_id", "rank").collect()
    own = list(enumerate(x))
    hit = total = 0
    for q in range(0, len(x), 20):
        true, mine = _nearest(own, q), [(r.score, r.vec_id) for r in got if r.query_id == q]
        assert len(mine) == len(true) and mine == sorted(mine)
        hit, total = hit + len({i for _, i in mine} & {i for _, i in true}), total + len(true)
    assert hit >= 0.95 * total


def test_vamana_ties(spark):
    """A ring of equal distances: the smaller ids come first, copies included; all rows may be copies."""
    rows = [(k, [float(k % 4 == 0), float(k % 4 == 1), -float(k % 4 == 2), -float(k % 4 == 3)]) for k in range(40)] + [(100, [0.25] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = vamana.nearest(df, "vec_id", "embedding", F.col("vec_id") % 10 == 0, shard=30).orderBy("query_id", "rank").collect()
    own = [(i, np.array(v)) for i, v in rows]
    for q in (0, 10, 20, 30, 100):
        assert [(r.vec_id, r.score) for r in got if r.query_id == q] == [(i, d) for d, i in _nearest(own, q)]
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(30)], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in vamana.nearest(same, "vec_id", "embedding", F.col("vec_id") == 3).orderBy("rank").collect()] == [0, 1, 2, 4, 5, 6, 7, 8, 9, 10]


def _plain_score(m, s, text):
    """log10 of the product of p(w | h), each as a sum over all items, in double precision."""
    rank = {w: k for k, w in enumerate(s.words)}
    share = lambda w: s.prefixes.get(w.decode()[:2], s.shared - 1)
    item = lambda w: s.own + s.shared if w is None else rank[w] if rank.get(w, s.own) < s.own else s.own + share(w)
    q, b, r, c, u, a = (x.astype(float) for x in m._all())
    one = two = s.start
    gain = 0.0
    for w in [*lbl.words_of(text.encode()), None]:
        i, h = item(w), r[one] * c[0] + r[two] * c[1]
        k, same = m.class_of[i], np.flatnonzero(m.class_of == m.class_of[i])
        p = math.exp(b[k] + h @ q[k]) / sum(math.exp(x + h @ y) for x, y in zip(b, q, strict=True))
        p *= math.exp(a[i] + h @ u[i]) / sum(math.exp(a[x] + h @ u[x]) for x in same)
        gain += math.log10(p) - math.log10(s.weight[i] / s.total)
        one, two = i, one
    return gain


def test_language_model_score(spark, docs, rows, monkeypatch):
    """Scores are those of plain sums, and the same however the rows are split."""
    from sheetgraph.llm.common import fold

    real, seen = lbl.train, []
    monkeypatch.setattr(lbl, "train", lambda coded, s, dim: seen.append((real(coded, s, dim, share=4000), s)) or seen[-1][0])
    got = [lbl.score(docs.repartition(k), fold("doc_id", 5, 1), head=50).where("doc_id is not null").collect() for k in (1, 7)]
    assert [Counter((r.doc_id, round(r.score, 4)) for r in x) for x in got][0] == Counter((r.doc_id, round(r.score, 4)) for r in got[1])
    m, s = seen[0]
    assert np.isclose(s.weight.sum(), s.total + 0.5 * (s.shared - 1)) and (m.params() != lbl.LogBilinear(s.weight, s.class_of_item()).params()).any()
    want = {(i, x): _plain_score(m, s, x or "") for i, x in rows if i is not None and len(x or "") < 2000}
    mine = {i: r.score - r.base_score for r in got[0] for i in [r.doc_id]}
    assert len(want) > 30 and all(abs(mine[i] - w) < 1e-3 * max(1, abs(w)) for (i, _), w in want.items())


def test_language_model_is_normalised_and_learns():
    weight, class_of = np.array([4.0, 3.0, 2.0, 1.0]), np.array([0, 1, 1, 1], np.int32)
    m = lbl.LogBilinear(weight, class_of, 6)
    y = np.tile([0, 1, 2, 3], 5000)
    one, two = np.roll(y, 1), np.roll(y, 2)
    before = m.log_probs(one, two, y).mean()
    t = lbl.Trainer(m, (20, 20))
    for _ in range(8):
        t.feed(one, two, y, 256)
    assert m.log_probs(one, two, y).mean() > before + 0.5
    every = np.exp(np.stack([m.log_probs(one[:50], two[:50], np.full(50, k)) for k in range(4)]))
    assert np.allclose(every.sum(axis=0), 1, atol=1e-5)
    again = lbl.LogBilinear(weight, class_of, 6).load(m.params())
    assert (again.log_probs(one[:50], two[:50], y[:50]) == m.log_probs(one[:50], two[:50], y[:50])).all()


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["an", "the", "er", "on", "is", "re"]) for _ in range(rng.randrange(1, 4)))
    good = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    docs, labels = [], []
    for k in range(400):
        bad, toxic = rng.random() < 0.3, rng.random() < 0.3
        t = [good(rng.randrange(5, 40)) for _ in range(rng.randrange(1, 8))]
        if bad:
            t.insert(rng.randrange(len(t) + 1), rng.choice(["BUY!! NOW!! " * 40, "spam " * 60, "a%%% b$$$ c*** " * 30]))
        if toxic:
            t.insert(rng.randrange(len(t) + 1), f"{good(3)} {rng.choice(['grobbo', 'zzivo' + word(), 'zzivo' + word()])} {good(4)}")
        docs.append((k, "\n".join(t)))
        labels.append((k, int(not bad), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), labels


def test_quality(spark, judged, docs, no_docs):
    from sheetgraph.llm.common import fold

    own, labels = judged
    m = mil_quality.train(own, _labels(spark, labels), fold("_id", 4, 2))
    truth = {i: q for i, q, _ in labels}
    wrong = [r for r in mil_quality.score(own, m).collect() if r.predicted != truth[r.doc_id]]
    assert len(wrong) <= 8
    assert mil_quality.score(docs, m).count() == docs.count() and mil_quality.score(no_docs, m).count() == 0
    kept = mil_quality.keep_good(docs, m)
    assert kept.columns == docs.columns
    assert mil_quality.train(own, _labels(spark, []), F.lit(False)) == 1.0
    assert mil_quality.train(no_docs, _labels(spark, labels), F.lit(False)) == 1.0
    assert mil_quality.score(docs, 1.0).where("predicted = 1").count() == docs.count()


def test_passage_grams():
    """Buckets against a plain loop over the words."""
    mask, golden = (1 << 64) - 1, 0x9E3779B97F4A7C15
    h = lambda w: sum(c * pow(int(mil_quality._P), k, 1 << 64) for k, c in enumerate(w)) & mask
    bucket = lambda v, kind: ((v * golden & mask) >> 51) + kind * mil_quality.BUCKETS
    said = [b"", b"  \t", b"One two\nTHREE  a bc", " ".join(f"Straße{k}" for k in range(150)).encode(), b"x", b" end "]
    ids, n, passages = mil_quality.grams(said)
    want, counts, per = [], [], []
    for t in said:
        words = [w for w in t.lower().split()]
        own = [words[k : k + mil_quality.PASSAGE] for k in range(0, max(1, len(words)), mil_quality.PASSAGE)]
        per.append(len(own))
        for p in own:
            got = [bucket(h(w), 0) for w in p] + [bucket(h(a) * golden + h(b) & mask, 1) for a, b in zip(p, p[1:], strict=False)]
            got += [bucket(h(w[:3]), 2) for w in p] + [bucket(h(w[-3:]), 3) for w in p]
            want += got
            counts.append(len(got))
    assert passages.tolist() == per and n.tolist() == counts and ids.tolist() == want


def test_attention_gradients():
    """The gradients are those of small steps of the loss, n-gram vectors included."""
    rng = np.random.default_rng(1)
    m = mil_quality.AttentionMIL(dim=3, hidden=5, gate=4)
    n, counts, y = np.array([3, 0, 2, 4]), np.array([1, 3]), np.array([1.0, 0.0])
    ids, x = rng.integers(0, 50, n.sum()).astype(np.uint16), rng.standard_normal((4, mil_quality.N_SIGNALS))
    m.table = m.table.astype(float)
    z = m.inputs(x, ids, n)

    def loss(z):
        p = 1 / (1 + np.exp(-m._forward(z, counts)[-1]))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    g, dz = m._backward(z, counts, y)
    for k, v in m.p.items():
        at = tuple(rng.integers(0, d) for d in v.shape)
        v[at] += 1e-5
        up = loss(z)
        v[at] -= 2e-5
        assert abs((up - loss(z)) / 2e-5 - g[k][at]) < 1e-6, k
        v[at] += 1e-5
    step = np.zeros_like(z)
    step[2, -1] = 1e-5
    assert abs((loss(z + step) - loss(z - step)) / 2e-5 - dz[2, -1]) < 1e-6


def test_toxicity(spark, judged, docs, no_docs):
    from sheetgraph.llm.common import fold

    own, labels = judged
    m = toxic_grammar.train(own, _labels(spark, labels), fold("_id", 5, 0))
    truth = {i: t for i, _, t in labels}
    wrong = [r for r in toxic_grammar.score(own, m).collect() if r.predicted != truth[r.doc_id]]
    assert len(wrong) <= 4
    assert toxic_grammar.score(docs, m).where("predicted = 1").count() == 0 == toxic_grammar.score(no_docs, m).count()
    assert toxic_grammar.keep_clean(docs, m).count() == docs.count()
    assert toxic_grammar.train(own, _labels(spark, []), F.lit(False)).insults == {}


def test_grammar_scopes():
    m = toxic_grammar.Model({"=fool": 3.0})
    s = lambda x: m.scorer()(x)[0]
    plain, aimed, negated, said, far = s("what a fool"), s("you are a fool"), s("it is not a fool"), s("it claims a fool came"), s("not now. a fool")
    assert aimed > plain > negated and plain > said and far == plain
    assert s("i will kill you") > s("kill time") and s("") == s("nothing here")
    loop = toxic_grammar.compose(toxic_grammar.scope("N", {"I": "n"}, 2), toxic_grammar.scope("n", {"o": "x"}, 1), "NIo")
    state, out = 0, ""
    for c in "NIoo":
        state, w = loop.step(state, c)
        out += w
    assert out == "Nnxo"


@pytest.mark.parametrize("aimed, threat, negated, reported", [
    ("you are a grobbo", "i will kill you", "this is not a grobbo", "it said a grobbo came"),
    ("du bist ein grobbo", "ich werde dich töten", "das ist kein grobbo", "man schrieb ein grobbo kam"),
    ("tu es un grobbo", "je vais te tuer", "ce n'est pas un grobbo", "on affirme un grobbo vient"),
    ("tú eres un grobbo", "ustedes van a matar", "nunca fue un grobbo", "se afirma un grobbo vino"),
])
def test_clauses_of_four_languages(spark, judged, aimed, threat, negated, reported):
    """Learned on planted labels: aimed insults and threats are toxic, negated and reported ones are not."""
    own, labels = judged
    m = toxic_grammar.train(own, _labels(spark, labels), F.lit(False))
    assert "=grobbo" in m.insults
    rate = m.scorer()
    assert [rate(x)[0] >= 0.5 for x in (aimed, threat, negated, reported)] == [True, True, False, False]
    assert rate("ein grobbo")[0] >= 0.5 and rate("tuer")[0] < 0.5


def test_packed_files(docs, tmp_path, spark):
    packed = bfd_packing.pack(docs, WORDS, window=256, cell_tokens=2000)
    bfd_packing.write_packed(packed, f"file://{tmp_path}/packed")
    back = bfd_packing.read_packed(spark, f"file://{tmp_path}/packed").collect()
    assert [r.sequence_id for r in back] == sorted(r.sequence_id for r in back)
    assert {r.sequence_id: bytes(r.ids) for r in back} == {r.sequence_id: bytes(r.ids) for r in packed.collect()}
