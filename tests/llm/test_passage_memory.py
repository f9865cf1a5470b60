"""Passages are hashed by chunks: equal to one hash at a time, in memory that does not grow with a text."""

import tracemalloc

import numpy as np
import pytest

from sheetgraph.llm import mil_quality as mq


def plain(text):
    """The n-grams' buckets of each passage, hash by hash."""
    words, out = text.split(), []
    h = lambda w: sum(c * pow(int(mq._P), k, 1 << 64) for k, c in enumerate(w.lower())) % (1 << 64)
    mix = 0x9E3779B97F4A7C15
    for at in range(0, max(len(words), 1), mq.PASSAGE):
        own = words[at : at + mq.PASSAGE]
        kinds = [[h(w) for w in own], [(h(a) * mix + h(b)) % (1 << 64) for a, b in zip(own, own[1:])], [h(w[:3]) for w in own], [h(w[-3:]) for w in own]]
        out.append([((x * mix % (1 << 64)) >> 51) % (1 << 16) + k * mq.BUCKETS for k, xs in enumerate(kinds) for x in xs])
    return out


@pytest.mark.parametrize("chunk", [50, 700, 1 << 18])
def test_chunks_equal_hashes_one_by_one(monkeypatch, chunk):
    monkeypatch.setattr(mq, "CHUNK", chunk)
    mq._powers.cache_clear()
    rng = np.random.default_rng(chunk)
    texts = [b" ".join(bytes(rng.integers(65, 123, rng.integers(1, 30)).astype(np.uint8)) for _ in range(n)) for n in (0, 1, 64, 65, 300)] + [b"", b"x" * 900 + b" Tail", b"\n a\t"]
    ids, n, passages = mq.grams(texts)
    mq._powers.cache_clear()
    expected = [p for t in texts for p in plain(t)]
    assert n.tolist() == [len(p) for p in expected] and ids.tolist() == [x for p in expected for x in p]
    assert passages.tolist() == [len(plain(t)) for t in texts]


def test_a_long_word_is_hashed_in_bounded_memory():
    mq.grams([b"a"])
    text = b"word " + b"z" * 20_000_000 + b" end"
    tracemalloc.start()
    ids, n, passages = mq.grams([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n.tolist() == [11] and passages.tolist() == [1] and peak < 8 * len(text)
    assert sum(a.nbytes for a in [mq._powers()]) < 10_000_000
