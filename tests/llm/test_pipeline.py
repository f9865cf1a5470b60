"""The pipeline: each stage does what its operator says of its own input, odd rows included."""

from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sheetgraph.llm import mil_quality, simhash, toxic_grammar
from sheetgraph.llm.common import fold, table
from sheetgraph.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"


def _one_of_each(rows):
    """The ids that stay: the least of each component of pairs with a five-word Jaccard similarity of 0.8 or more."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if root[i] != root[j] and (a == b or len(a & b) >= 0.8 * len(a | b)):
                lo, hi = sorted((root[i], root[j]))
                root = [lo if r == hi else r for r in root]
    return {min(r[0] for r, k in zip(rows, root, strict=True) if k == c) for c in set(root)}


def test_stages_follow_their_operators(spark):
    docs, names = table(spark, SF, "documents"), [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "toxicity", "simhash", "packing"]
    labels = table(spark, SF, "labels")
    first = corpus_pipeline.quality(spark, docs, SF).cache()
    m = mil_quality.train(docs, labels, fold("_id", 4, 2))
    rated = {d.doc_id: s >= 0.7 for d, s in zip(docs.orderBy("doc_id").collect(), mil_quality.rate(m, [(d.text or "").encode() for d in docs.orderBy("doc_id").collect()]), strict=True)}
    assert {r.doc_id for r in first.collect()} == {d for d, ok in rated.items() if ok} and first.columns == docs.columns
    second = corpus_pipeline.toxicity(spark, first, SF).cache()
    t = toxic_grammar.train(first, labels, fold("_id", 5, 0))
    rate = t.scorer()
    assert {r.doc_id for r in second.collect()} == {r.doc_id for r in first.collect() if rate(r.text or "")[0] < 0.5}
    third = corpus_pipeline.near_duplicates(spark, second, SF).cache()
    assert third.columns == docs.columns and {r.doc_id for r in third.collect()} == _one_of_each([(r.doc_id, r.text) for r in second.collect()])
    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    length = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in third.collect()}
    pieces = corpus_pipeline.packing(spark, third, SF).collect()
    done = corpus_pipeline.run(spark, SF).collect()
    for rows in (pieces, done):
        held = Counter()
        for p in rows:
            held[p.doc_id] += p.length
        assert held == length


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """A folder of tables with nulls, empty and repeated rows, a very long text and columns named like the operators' own."""
    good = [r.text for r in table(spark, SF, "documents").where("text is not null").limit(40).collect()]
    rows = [(k, t) for k, t in enumerate(good)] + [(3, good[3]), (3, good[5]), (None, good[7]), (None, "a text without an id"), (None, None), (90, None), (91, ""), (92, " \t\n"), (93, " ".join(good * 3))]
    names = ["node", "size", "s0", "row", "d", "best", "component", "_id", "y", "__node"]
    out = tmp_path_factory.mktemp("odd")
    df = spark.createDataFrame([(i, t, *[k] * len(names)) for k, (i, t) in enumerate(rows)], "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    df.write.parquet(f"{out}/documents.parquet")
    df.limit(0).write.parquet(f"{out}/none/documents.parquet")
    for where in (out, out / "none"):
        spark.createDataFrame([(k, 1, 0) for k in range(20)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return str(out), rows


def test_odd_rows(spark, odd):
    folder, rows = odd
    docs = table(spark, folder, "documents")
    first = corpus_pipeline.quality(spark, docs, folder)  # labels of one class alone: all are good
    assert first.count() == len(rows) and first.columns == docs.columns
    second = corpus_pipeline.toxicity(spark, first, folder)
    assert second.count() == len(rows) and second.columns == docs.columns
    third = corpus_pipeline.near_duplicates(spark, second, folder)
    kept = [(r.doc_id, r.text) for r in third.collect()]
    assert third.columns == docs.columns and len(kept) == len(set(kept))
    classes = _one_of_each([(10**6 if i is None else i, t) for i, t in rows])
    assert Counter(10**6 if i is None else i for i, _ in kept).keys() == classes
    assert (None, "a text without an id") in kept and sum(not (t or "").split() for _, t in kept) == 1
    done = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in done.collect()} == {i for i, _ in kept}
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0


def test_wide_fingerprints_and_radii():
    """Pairs told by bit planes are those of a plain count, for words and rows of words."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, (6, 2), dtype=np.uint64)
    rows = np.stack([base[k % 6] ^ np.array([sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 25), replace=False)) for _ in range(2)], np.uint64) for k in range(150)])
    for radius in (0, 1, 2, 7, 34, 63):
        i, j = simhash.close_pairs(rows, None, radius)
        far = np.bitwise_count(rows[:, None] ^ rows[None]).sum(axis=2)
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a in range(150) for b in range(a + 1, 150) if far[a, b] <= radius}
        i, j = simhash.close_pairs(rows[:40], rows[40:], radius)
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a in range(40) for b in range(110) if far[a, 40 + b] <= radius}
