"""Near copies against brute force over the sets of shingles."""

import numpy as np
import pytest

import corpus_pipeline
from sheetgraph.llm import near_copies
from sheetgraph.llm.common import table


def _brute(rows):
    """The (doc_id, text) that stay: the least of each component of pairs of Jaccard 0.8 or more."""
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
    return len(set(root)), [min(r[0] for r, k in zip(rows, root, strict=True) if k == c) for c in set(root)]


def test_edited_copies_are_dropped(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(30):
        words = [f"w{x}" for x in rng.integers(0, 5000, 150)]
        rows.append((10 * k, " ".join(words)))
        for n in range(1, 4):  # one to three words changed: Jaccard 0.93 to 0.81 or so
            copy = list(words)
            for at in rng.choice(140, n, replace=False):
                copy[at] = f"new{n}"
            rows.append((10 * k + n, " ".join(copy)))
        rows.append((10 * k + 5, " ".join(words[:70] + [f"x{x}" for x in rng.integers(0, 5000, 80)])))
    rows += [(900, ""), (901, None), (902, "short text"), (903, "Short  text"), (904, "short texts")]
    n, ids = _brute(rows)
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(r.doc_id for r in got) == sorted(ids) and n == len(got) < 70


def test_small_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").limit(600)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in out) == sorted(_brute(rows)[1])


def test_one_row_of_each_class(spark):
    a, b, c = "first text of two rows and more", "second text under an id in use", "third text that has no id at all"
    rows = [(3, a), (5, a), (5, b), (None, a), (None, c), (None, c)]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert {(r.doc_id, r.text) for r in got} == {(3, a), (5, b), (None, c)} and len(got) == 3


def test_groups_are_cut_into_blocks(spark):
    """A chain of near copies that only neighbours link, verified in blocks of a few texts."""
    rng = np.random.default_rng(5)
    words, rows = [f"w{x}" for x in rng.integers(0, 9000, 200)], []
    for k in range(60):
        rows.append((1, k, " ".join(words)))
        for at in rng.choice(190, 3, replace=False):
            words[at] = f"n{k}x{at}"
    rows += [(1, 100 + k, " ".join(f"z{x}" for x in rng.integers(0, 9000, 50))) for k in range(20)]
    df = spark.createDataFrame(rows, "component long, node long, text string")
    n, _ = _brute([(k, t) for _, k, t in rows])
    for most in (512, 7):
        links = near_copies.verified(df, 5, 0.8, most).collect()
        root = {k: k for _, k, _ in rows}
        for a, b in links:
            lo, hi = sorted((root[a], root[b]))
            root = {k: lo if r == hi else r for k, r in root.items()}
        assert len(set(root.values())) == n < 40


@pytest.mark.parametrize(("similarity", "changed"), [(0.6, range(36, 45)), (0.7, range(25, 30))])
def test_pairs_just_over_a_lower_threshold_are_found(spark, similarity, changed):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(120):
        words = [f"w{x}" for x in rng.integers(0, 50_000, 200)]
        m = changed[k % len(changed)]
        at = int(rng.integers(0, 200 - m))
        other = words[:at] + [f"v{x}" for x in rng.integers(0, 50_000, m)] + words[at + m :]
        a, b = ({tuple(w[i : i + 5]) for i in range(196)} for w in (words, other))
        assert similarity <= len(a & b) / len(a | b) < similarity + 0.09
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    got = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), similarity=similarity).collect()
    assert len(got) <= 121 and {r.doc_id for r in got} >= set(range(0, 240, 2))


def test_radii_follow_the_similarity():
    assert near_copies.radii(0.8) == (34, 72)
    assert near_copies.radii(0.6) > near_copies.radii(0.7) > near_copies.radii(0.8)
    with pytest.raises(ValueError):
        near_copies.samples(10**9, 0.3)
