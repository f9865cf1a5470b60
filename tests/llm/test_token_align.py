"""Alignment of two tokenizers against a plain walk over both token lists, on odd texts and cuts."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sheetgraph.llm import token_align
from sheetgraph.llm.queries import queries

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, batch int, groups string"


@pytest.fixture(scope="module")
def encode():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letter = token_align.byte_table()
    a_bytes = {k: bytes(letter[c] for c in t) if all(c in letter for c in t) else t.encode() for t, k in a.get_vocab().items()}

    def b_bytes(k):
        piece = b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()

    def run(text):
        """Ids of A and B of a whole text, each with its bytes; none where these differ from the text's."""
        if not text:
            return [], []
        x = [(k, a_bytes[k]) for k in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(k, b_bytes(k)) for k in b.encode(text)]
        raw = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == raw == b"".join(t for _, t in y) else ([], [])

    return run


def plain(rows, encode):
    """The contract's rows, by sets of byte ends and by comparing the ranges of neighbouring tokens."""
    out, counts = [], Counter()
    for d, text in rows:
        sides = []
        for own in encode(text):
            ends = np.cumsum([len(t) for _, t in own]).tolist()
            sides.append([(k, e - len(t), e) for (k, t), e in zip(own, ends, strict=True)])
        a, b = sides
        links, at = [], 0
        for k, lo, hi in a:
            while at < len(b) and b[at][2] <= lo:
                at += 1
            n = at
            while n < len(b) and b[n][1] < hi:
                links.append((k, b[n][0]))
                n += 1
        cuts = [0, *sorted({e for *_, e in a} & {e for *_, e in b})]
        starts = [[t[1] for t in side] for side in (a, b)]
        groups = ["|".join(",".join(str(t[0]) for t in side[bisect_left(lo, x) : bisect_left(lo, y)]) for side, lo in zip((a, b), starts, strict=True)) for x, y in zip(cuts, cuts[1:], strict=False)]
        counts.update(links)
        out.append((d, len(a), len(b), len(cuts) - 1, links, ";".join(groups)))
    most = {}
    for (_, k), n in counts.items():
        most[k] = max(n, most.get(k, 0))
    return [(d, na, nb, g, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), said) for d, na, nb, g, links, said in out]


def odd(n, seed):
    rng = random.Random(seed)
    bits = [" ", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\r", "\x1c", "\x0b", "\x85", " ", "　", "​", "▁", "a", "It's", "'s", "the", "Straße", "日本", "é", "é", "🙂", "12", "3.5", "(x)", "<s>", "<|endoftext|>", "<0x41>", "<unk>", "\x00", "»", "if (a) {", "}", ";", "w" * 30]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def test_parts_are_the_whole(encode):
    """Encoding part by part, some thousand at once and with a small cache, equals encoding whole texts."""
    e = token_align.PartEncoder(A, B, limit=50)
    texts = odd(3000, 1)
    for at in range(0, len(texts), 500):
        own = texts[at : at + 500]
        cut = [e.cut(t) for t in own]
        assert ["".join(c) for c in cut] == [" " + t for t in own]
        k, good, (n_a, a), (n_b, b) = e.encode([p for c in cut for p in c])
        s_a, s_b, i = np.r_[0, np.cumsum(n_a)], np.r_[0, np.cumsum(n_b)], 0
        for t, c in zip(own, cut, strict=True):
            parts, i = k[i : i + len(c)], i + len(c)
            want = encode(t)
            if all(good[parts]):
                assert [x for p in parts for x in a[s_a[p] : s_a[p + 1]]] == [x for x, _ in want[0]]
                assert [x for p in parts for x in b[s_b[p] : s_b[p + 1]]] == [x for x, _ in want[1]]
            else:
                assert want == ([], [])
    assert len(e._at) == 50


def test_bitsets():
    rng = np.random.default_rng(0)
    places = np.unique(rng.integers(0, 1000, 300))
    bits = token_align.Bits.of(places, 1000)
    assert bits.select().tolist() == places.tolist()
    at = np.arange(1001)
    assert bits.rank(at).tolist() == [int((places < x).sum()) for x in at]


@pytest.fixture(scope="module")
def rows(spark):
    base = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).collect()]
    return base + [(5000 + k, t) for k, t in enumerate(odd(400, 2))] + [(None, "no id"), (None, None), (1, ""), (2, "same text"), (2, "same text"), (3, "x" * 20_000), (4, "日本語" * 3000), (6, "the cat " * 5000)]


@pytest.mark.parametrize("popular", [1, 65_536])
def test_all_rows(spark, rows, encode, popular, monkeypatch):
    monkeypatch.setattr(token_align, "ROWS", 37)
    df = spark.createDataFrame([(d, t, 1, "g") for d, t in rows], SCHEMA).repartition(4)
    got = token_align.align(df, A, B, popular=popular)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert Counter(map(tuple, got.collect())) == Counter(plain(rows, encode))


def test_query_and_empty_table(spark, tmp_path, encode):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    base.write.parquet(f"{tmp_path}/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in base.collect()], encode)
    df = queries()["op13_token_align"](spark, str(tmp_path))
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, df.collect())) == Counter((*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in want)
    assert token_align.align(base.limit(0), A, B).count() == 0


def test_pair_counts(spark, encode):
    rows = [(k, t) for k, t in enumerate(odd(50, 9))]
    df = spark.createDataFrame([(d, t, 1, "g") for d, t in rows], SCHEMA)
    for held in (10, 500_000):
        got = token_align.link_counts(df, A, B, held).collect()
        assert sum(r["count"] for r in got) == sum(r[4] for r in plain(rows, encode))
        for k in {r.pair & 65535 for r in got}:
            own = [r for r in got if r.pair & 65535 == k]
            assert {r.best for r in own if r["count"] == max(x["count"] for x in own)} == {1} and sum(r.best for r in own) == sum(r["count"] == max(x["count"] for x in own) for r in own)


def test_ranks_give_the_same_ids():
    """The faster encoder of A is in use, and equals the tokenizer on odd texts and on long words."""
    e = token_align.PartEncoder(A, B)
    assert e._ranked
    rng = random.Random(4)
    texts = [" " + t for t in odd(2000, 7)] + ["".join(rng.choice("etaoinshrdlu") for _ in range(3000))]
    assert [e._ranked(t) for t in texts] == [x.ids for x in e._a.encode_batch(texts, add_special_tokens=False)]
