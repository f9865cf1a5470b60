"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexicon transducer maps words to symbols: insult, threat, target, negation, report. Three
small transducers rewrite what follows: an insult or threat under a negation or in reported
speech is marked so, one aimed at a target too. Their composition carries weights on its arcs
and runs over each clause that holds an insult or threat: the weights of the arcs, and the
words' own weights (a small share of them under a negation or report), are summed along the
path, and the worst clause is the document's. Insults (words and stems) and the weights of the
arcs (one for each output symbol, and the share) are learned from a bounded sample of labelled
rows; threats, targets, negations and reports are fixed lists of four languages.

Edge cases: a null or empty text has no clause and gets the score of no match; without
labelled rows only the fixed lexicon speaks; repeated rows get equal scores; a null doc_id is
kept and not held out; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetgraph.llm.common import keep_where, split_batches, stash
from sheetgraph.llm.labelled import sample

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "I", "H", "T", "N", "R", "o"
#: Fixed lexicon of the symbols that labels do not teach, in English, German, French and Spanish.
THREATS = frozenset(
    """kill murder hurt shoot stab strangle beat burn destroy punish crush
    töten umbringen ermorden verprügeln erschießen erstechen verbrennen vernichten
    tuer tuerai assassiner frapper poignarder brûler détruire écraser
    matar mataré asesinar golpear apuñalar quemar destruir aplastar""".split()
)
TARGETS = frozenset(
    """you your yours yourself he she they him her them these those people everyone
    du dich dir dein deine ihr euch euer sie er ihn ihm
    tu toi te ton ta tes vous votre il elle ils elles eux
    tú ti tus usted ustedes él ella ellos ellas vosotros""".split()
)
NEGATIONS = frozenset(
    """not no never isn't aren't wasn't weren't don't doesn't didn't nobody none without
    nicht kein keine keinen keiner nie niemals niemand ohne
    pas jamais aucun aucune sans
    nunca jamás ningún ninguna ninguno nadie sin""".split()
)
REPORTS = frozenset(
    """said says say wrote claimed claims reported reports called quoted stated told alleged
    sagte sagt schrieb behauptet behauptete berichtet nannte zitierte
    dit disait écrit écrivait affirme prétend rapporte appelé cité
    dijo dice escribió afirma afirmó alega llamó citó""".split()
)
#: Weights of the output symbols before any label is seen, and the share of an insult's own weight that counts under a negation or report.
PRIOR = {"I": 0.0, "n": -1.0, "r": -1.0, "t": 1.0, "+": 1.0, "H": 0.0, "h": 6.0, "m": -3.0, "q": -3.0}
HELD, UNDER = 0.1, "nrmq"
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:\n]+")
#: Lengths of stems that can be learned beside whole words.
STEMS = (6, 5, 4)


@dataclass
class Transducer:
    """Deterministic: (state, input symbol) -> (state, output symbols). Missing arcs copy the symbol and go to `otherwise`."""

    arcs: dict[tuple[int, str], tuple[int, str]] = field(default_factory=dict)
    otherwise: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol)) or (self.otherwise.get(state, 0), symbol)


def scope(opener: str, rewrite: dict[str, str], reach: int) -> Transducer:
    """After `opener`, symbols are rewritten for the next `reach` words."""
    t = Transducer()
    for s in range(reach + 1):
        t.arcs[s, opener] = (reach, opener)
        t.otherwise[s] = max(0, s - 1)
        if s:
            for a, b in rewrite.items():
                t.arcs[s, a] = (s - 1, b)
    return t


def aimed(reach: int) -> Transducer:
    """Insults and threats after a target are aimed at it. A target soon after adds '+' to an insult and 'h' to a threat.

    States below 0 count down the words after an insult, those below `-reach` after a threat.
    """
    t = scope(TARGET, {"I": "t", "H": "h"}, reach)
    after_insult, after_threat = -reach, -2 * reach
    for s in range(after_threat, 1):
        t.arcs[s, "I"], t.arcs[s, "H"] = (after_insult, "I"), (after_threat, "H")
        if s < 0:
            t.otherwise[s] = 0 if s + 1 == after_insult else s + 1
            t.arcs[s, TARGET] = (reach, "h" if s < after_insult else "+")
    return t


def compose(first: Transducer, second: Transducer, symbols: str) -> Transducer:
    """The transducer that runs `second` over what `first` writes; only states that can be reached."""
    number, todo, out = {(0, 0): 0}, [(0, 0)], Transducer()
    while todo:
        a, b = todo.pop()
        for s in symbols:
            a2, written = first.step(a, s)
            b2, text = b, ""
            for w in written:
                b2, more = second.step(b2, w)
                text += more
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            out.arcs[number[a, b], s] = (number[a2, b2], text)
    return out


def grammar() -> Transducer:
    negated = scope(NEGATION, {"I": "n", "H": "m"}, 3)
    reported = scope(REPORT, {"I": "r", "H": "q", "n": "r", "m": "q"}, 6)
    return compose(compose(negated, reported, "IHTNRo"), aimed(4), "IHTNRo")


class Lexicon(dict):
    """word -> (symbol, weight), worked out once for each word; bounded like the other caches."""

    def __init__(self, insults: dict[str, float], limit: int = 300_000):
        super().__init__()
        self._insults, self._limit = insults, limit

    def __missing__(self, word: str) -> tuple[str, float] | None:
        w = self._insults.get(f"={word}")
        for n in STEMS:
            if w is None and len(word) >= n:
                w = self._insults.get(word[:n])
        if w is not None:
            got = (INSULT, w)
        elif word in THREATS:
            got = (THREAT, 0.0)
        else:
            got = None
        if len(self) < self._limit:
            self[word] = got
        return got


def _symbol(word: str) -> str:
    return TARGET if word in TARGETS else NEGATION if word in NEGATIONS else REPORT if word in REPORTS else OTHER


def clauses(text: str, lexicon: Lexicon) -> Iterator[list[tuple[str, float]]]:
    """The input of each clause with an insult or threat: its words' symbols and own weights."""
    text = text.lower()
    if not any(map(lexicon.__getitem__, _WORD.findall(text))):
        return
    for clause in _CLAUSE.split(text):
        words = _WORD.findall(clause)
        found = [lexicon[w] for w in words]
        if any(found):
            yield [hit or (_symbol(word), 0.0) for word, hit in zip(words, found, strict=True)]


def trace(clause: list[tuple[str, float]], fst: Transducer) -> tuple[Counter, float, float]:
    """How often each output symbol is written, the insults' own weight, and the part of it under a negation or report."""
    state, written, plain, under = 0, Counter(), 0.0, 0.0
    for symbol, weight in clause:
        state, out = fst.step(state, symbol)
        written.update(x for x in out if x in PRIOR)
        if any(x in UNDER for x in out):
            under += weight
        else:
            plain += weight
    return written, plain, under


@dataclass
class Model:
    insults: dict[str, float]
    symbols: dict[str, float] = field(default_factory=lambda: dict(PRIOR))
    held: float = HELD
    bias: float = -4.0

    def machine(self) -> dict[tuple[int, str], tuple[int, float, float]]:
        """The composed transducer with weights on its arcs: (state, symbol) -> (state, weight, share of the word's own weight)."""
        return {k: (state, sum(self.symbols.get(x, 0.0) for x in out), self.held if any(x in UNDER for x in out) else 1.0) for k, (state, out) in grammar().arcs.items()}

    def scorer(self):
        """The function of a text to its score and number of matched clauses; built once a task."""
        lexicon, arcs = Lexicon(self.insults), self.machine()

        def score(text: str) -> tuple[float, int]:
            best, n = 0.0, 0
            for clause in clauses(text, lexicon):
                state, total, n = 0, 0.0, n + 1
                for symbol, weight in clause:
                    state, arc, share = arcs[state, symbol]
                    total += arc + share * weight
                best = max(best, total)
            return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.bias + best)))), n

        return score


def _features(words: set[str]) -> set[str]:
    out = {f"={w}" for w in words}
    for n in STEMS:
        out |= {w[:n] for w in words if len(w) >= n}
    return out


def train(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", most: int = 5000, least: int = 3, purity: float = 0.97) -> Model:
    """Insults by a greedy cover of the toxic documents with words and stems that clean ones hardly hold; then the symbols' weights."""
    labelled = stash(sample(docs, labels, label, held_out, most), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for b in split_batches(batches, 512):
            for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True):
                seen[y].update(_features(set(_WORD.findall((t or "").lower()))))
            if len(seen[0]) + len(seen[1]) > 400_000:
                yield table_of(seen)
                seen = (Counter(), Counter())
        yield table_of(seen)

    def table_of(seen: tuple[Counter, Counter]) -> pa.RecordBatch:
        keys = list(seen[0].keys() | seen[1].keys())
        return pa.RecordBatch.from_pydict({"f": pa.array(keys, pa.string()), "clean": pa.array([seen[0][k] for k in keys], pa.int64()), "toxic": pa.array([seen[1][k] for k in keys], pa.int64())})

    totals = {r["y"]: r["n"] for r in labelled.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = totals.get(0, 0), totals.get(1, 0)
    if not n_toxic:
        return Model({})
    # rates, not counts: the two classes are sampled to different shares
    pure = (F.col("toxic") / n_toxic) / (F.col("toxic") / n_toxic + F.col("clean") / max(n_clean, 1)) >= purity
    counted = labelled.mapInArrow(count, "f string, clean long, toxic long").groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where((F.col("toxic") >= 2) & pure).orderBy(F.desc("toxic"), "f").collect()
    weight = {r["f"]: min(12.0, math.log((r["toxic"] + 0.5) / n_toxic) - math.log((r["clean"] + 0.5) / max(n_clean, 1)) + math.log1p(r["toxic"])) for r in counted}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in split_batches(batches, 512):
            words = [_WORD.findall((t or "").lower()) for t in b.column("text").to_pylist()]
            own = [sorted(_features(set(w)) & weight.keys()) for w in words]
            after = [sorted({f"{y} {x}" for x, y in zip(["", *w], w, strict=False) if f"={y}" in weight}) for w in words]
            yield pa.RecordBatch.from_pydict({"f": pa.array(own, pa.list_(pa.string())), "after": pa.array(after, pa.list_(pa.string()))})

    rows = labelled.where("y = 1").mapInArrow(held, "f array<string>, after array<string>").collect()
    toxic = [set(r["f"]) for r in rows]
    contexts = Counter(f"={x.split(' ')[0]}" for x in {x for r in rows for x in r["after"]})  # different words before each word
    gain, where = Counter(), {}
    for k, own in enumerate(toxic):
        gain.update(own)
        for f in own:
            where.setdefault(f, []).append(k)
    words_of = Counter(f[1 : n + 1] for f in weight if f[0] == "=" for n in STEMS if len(f) > n)
    clean = {r["f"]: r["clean"] * n_toxic / max(n_clean, 1) for r in counted}
    insults, covered = {}, set()
    # a clean document costs as much as ten toxic ones gain; whole words go before stems, long stems before short ones
    worth = lambda f: (gain[f] - 10 * clean[f], f[0] == "=", len(f), f)
    heap = [_Down(worth(f), f) for f in gain]
    heapq.heapify(heap)
    while heap:  # gains only fall, so a feature whose worth has not changed is the best one
        best = heapq.heappop(heap)
        if (now := worth(best.f)) != best.worth:
            heapq.heappush(heap, _Down(now, best.f))
            continue
        f = best.f
        if now[0] < (least if f[0] == "=" or words_of[f] < 2 else 2):
            break
        insults[f] = weight[f]
        for k in where[f]:
            if k not in covered:
                covered.add(k)
                gain.subtract(toxic[k])
    # more that no clean document holds, though their documents are covered by now: stems of several words and words
    # after many different words (what copies of one document share has neither)
    for r in counted:
        f = r["f"]
        if not r["clean"] and r["toxic"] >= 5 * least and (contexts[f] >= 0.4 * r["toxic"] if f[0] == "=" else words_of[f] >= 4):
            insults.setdefault(f, weight[f])
    start = Model(insults)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, fst = Lexicon(insults), grammar()
        for b in split_batches(batches, 512):
            rows = []
            for t in b.column("text").to_pylist():
                found = [trace(c, fst) for c in clauses(t or "", lexicon)]
                written, plain, under = max(found, key=lambda f: f[1] + start.held * f[2] + sum(start.symbols[x] * n for x, n in f[0].items())) if found else (Counter(), 0.0, 0.0)
                rows.append([plain, under, *[float(written[x]) for x in PRIOR]])
            yield pa.RecordBatch.from_pydict({"y": b.column("y"), "x": pa.array(rows, pa.list_(pa.float64()))})

    got = labelled.mapInArrow(run, "y int, x array<double>").collect()
    x, y = np.array([r["x"] for r in got]), np.array([r["y"] for r in got], float)
    prior = np.array([HELD, *PRIOR.values()])
    b, s = -4.0, prior.copy()
    width = 1 / np.maximum(1, np.abs(x[:, 1:]).max(axis=0))  # counts are not capped: each is scaled for the steps alone
    for _ in range(300):  # logistic regression around the prior weights
        p = 1 / (1 + np.exp(-np.clip(b + x[:, 0] + x[:, 1:] @ s, -40, 40)))
        b -= 2.0 * ((p - y).mean() + 0.002 * (b + 4.0))
        s -= 2.0 * (width * (x[:, 1:].T @ (p - y)) / len(y) + 0.002 * (s - prior))
    return Model(insults, dict(zip(PRIOR, s[1:].tolist(), strict=True)), float(np.clip(s[0], 0, 1)), float(b))


class _Down:
    """An entry of a heap whose largest worth comes first."""

    def __init__(self, worth: tuple, f: str):
        self.worth, self.f = worth, f

    def __lt__(self, other: "_Down") -> bool:
        return self.worth > other.worth


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted and matched_clauses of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rate = model.scorer()
        for b in split_batches(batches, 512):
            found = [rate(t or "") for t in b.column("text").to_pylist()]
            s = np.array([f[0] for f in found], float)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "score": pa.array(s, pa.float64()), "predicted": pa.array((s >= threshold).astype(np.int32)), "matched_clauses": pa.array([f[1] for f in found], pa.int32())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int, matched_clauses int")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """docs without the rows whose score reaches the threshold."""

    def judge():
        rate = model.scorer()
        return lambda column: [rate(t or "")[0] < threshold for t in column.to_pylist()]

    return keep_where(docs, judge)
