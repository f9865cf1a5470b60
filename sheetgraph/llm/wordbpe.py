"""Ids of the lower-case word BPE, by a cache of white-space-separated words.

The tokenizer drops white space before it looks for words, so a text's ids are the ids of
its ASCII-white-space-separated parts, one after another. Each distinct part is encoded
once per worker. The cache keeps the first `limit` parts, which holds all frequent ones;
parts beyond it are encoded anew each time, so memory is bounded and ids never differ.
A text is cut at the tokenizer's own special tokens first (as they are written, before any
lower-casing), each of which is its one id.
"""

from __future__ import annotations

import re
from itertools import repeat
from unicodedata import is_normalized

import numpy as np

#: One full stop or comma after an ASCII letter or digit and before white space or the end is a word of its own.
_MARK = re.compile(rb"(?<=[a-z0-9])([.,])(?=\s|\Z)")
_WORKER: dict[str, "WordEncoder"] = {}


def worker_encoder(path: str) -> "WordEncoder":
    """The encoder of this Python worker, kept between tasks."""
    if path not in _WORKER:
        _WORKER[path] = WordEncoder(path)
    return _WORKER[path]


def _words(text: bytes) -> list[bytes]:
    if b"\xcc" not in text and b"\xcd" not in text:  # without combining marks, ASCII letters can be lowered before normalisation
        text = _MARK.sub(rb" \1", text.lower())
    return text.split()


class WordEncoder:
    def __init__(self, path: str, limit: int = 1_000_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._t = Tokenizer.from_file(path)
        self._t.encode_special_tokens = True  # special tokens are cut out before, by _special
        added = {t.content.encode(): k for k, t in self._t.get_added_tokens_decoder().items()}
        self._special = re.compile(b"(" + b"|".join(sorted(map(re.escape, added), key=len, reverse=True)) + b")") if added else None
        self._first = {t[:2] for t in added}
        self._last = np.zeros(self._t.get_vocab_size(), bool)
        self._last[[k for t, k in self._t.get_vocab().items() if t.endswith("</w>")]] = True
        self._limit = limit
        self._at: dict[bytes, int] = {}
        self._ids = np.zeros(1 << 16, np.uint16)
        self._start = np.zeros((1 << 14) + 1, np.int32)
        self._n = 0
        for t, k in added.items():  # no part holds a space, so these keys are theirs alone
            self._store([b" " + t], np.ones(1, np.int64), np.array([k], np.uint16))

    def _add(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8") for w in words]
        plain = [k for k, t in enumerate(texts) if t.isalpha() and (t.isascii() or (t.lower().isalpha() and is_normalized("NFC", t)))]
        counts = np.zeros(len(words), np.int64)
        parts: list[np.ndarray] = []
        if plain:  # letters alone are one word, whose last id marks a word's end
            ids = np.array(self._t.encode(" ".join([texts[k] for k in plain]), add_special_tokens=False).ids, np.uint16)
            ends = np.flatnonzero(self._last[ids])
            if len(ends) == len(plain) and ends[-1] == len(ids) - 1:
                counts[plain] = np.diff(ends, prepend=-1)
                parts.append(ids)
            else:  # the tokenizer knows a letter of these as something else
                plain = []
        other = sorted(set(range(len(words))).difference(plain))
        if other:
            encoded = [x.ids for x in self._t.encode_batch([texts[k] for k in other], add_special_tokens=False)]
            counts[other] = [len(x) for x in encoded]
            parts.append(np.fromiter((i for x in encoded for i in x), np.uint16))
        self._store([words[k] for k in (*plain, *other)], counts[[*plain, *other]], np.concatenate(parts))

    def _store(self, words: list[bytes], counts: np.ndarray, flat: np.ndarray) -> None:
        used = int(self._start[self._n])
        while used + len(flat) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while self._n + len(words) + 1 > len(self._start):
            self._start = np.concatenate([self._start, np.zeros_like(self._start)])
        self._ids[used : used + len(flat)] = flat
        self._start[self._n + 1 : self._n + len(words) + 1] = used + np.cumsum(counts)
        self._at.update(zip(words, range(self._n, self._n + len(words)), strict=True))
        self._n += len(words)

    def _parts(self, text: bytes) -> list[bytes]:
        if self._special is not None and any(x in text for x in self._first):
            cut = self._special.split(text)
            if len(cut) > 1:
                return [w for k, t in enumerate(cut) for w in ([b" " + t] if k % 2 else _words(t))]
        return _words(text)

    def encode_many(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint16) of all texts, given as UTF-8, one after another, and the count of each."""
        words, counts = [], []
        for t in texts:
            own = self._parts(t)
            counts.append(len(own))
            words += own
        at, kept = self._at, self._n
        k = np.fromiter(map(at.get, words, repeat(-1)), np.int32, len(words))
        missed = np.flatnonzero(k < 0).tolist()
        new = list(dict.fromkeys(words[i] for i in missed))
        if new:
            self._add(new)
            k[missed] = [at[words[i]] for i in missed]
        start = self._start[k].astype(np.int64)
        n = self._start[k + 1] - start
        total = int(n.sum())
        ids = self._ids[np.arange(total) + np.repeat(start - (np.cumsum(n) - n), n)]
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum([0, *counts])]
        if self._n > self._limit:
            for w in new:
                if at[w] >= max(kept, self._limit):
                    del at[w]
            self._n = max(kept, self._limit)
        return ids, np.diff(ends)

    def encode(self, text: bytes) -> np.ndarray:
        return self.encode_many([text])[0]
