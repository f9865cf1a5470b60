"""Hard negatives against a plain search, on ties, copies, odd rows and the registered query's SQL."""

from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sheetgraph.llm import pca_negatives
from sheetgraph.llm.queries import oracle_sql, queries

SCHEMA = "vec_id long, embedding array<float>, label int, block int, score string"


def plain(rows, every=10, k=5):
    """The contract by a scan of all pairs."""
    good = {}
    for i, v, label, *_ in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            w = tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)
            if sum(x * x for x in w) < 1 << 56:
                good[i] = min(good.get(i, (label, w)), (label, w))
    out = []
    for a, (label, v) in good.items():
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), i, o == label) for i, (o, w) in good.items() if i != a and len(w) == len(v)]
        own = sorted(x for x in scored if x[2])[:k]
        for p, i, _ in own:
            fits = sorted(x for x in scored if not x[2] and -80 * p <= -100 * x[0] <= -100 * p)[:k]
            out += [(a, i, r, j, -p, -s) for r, (s, j, _) in enumerate(fits, 1)]
    return Counter(out)


def mined(df, **more):
    return Counter(map(tuple, pca_negatives.mine(df, "vec_id", "embedding", F.col("label"), lambda i: i % 10 == 0, **more).collect()))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    base = rng.standard_normal((600, 24)) * (0.5 ** np.arange(24)) ** 0.3
    out = [(k, [float(x) for x in v], int(k % 4), 1, "s") for k, v in enumerate(base)]
    out += [(700 + k, [float(x) for x in base[7]], k % 3, 1, "s") for k in range(40)]  # copies under several labels
    out += [(800 + k, [float(x) for x in np.round(v)], k % 4, 1, "s") for k, v in enumerate(base[:60])]  # ties
    out += [(900, None, 1, 1, "s"), (910, [float("nan")] + [0.0] * 23, 1, 1, "s"), (920, [None] + [1.0] * 23, 1, 1, "s"), (930, [1.0] * 24, None, 1, "s"), (None, [1.0] * 24, 1, 1, "s"), (940, [0.0] * 24, 1, 1, "s"), (950, [], 1, 1, "s"), (951, [], 2, 1, "s"), (952, [], 1, 1, "s"), (960, [1.0, 2.0], 1, 1, "s"), (961, [1.0, 2.0], 1, 1, "s"), (962, [1.0, 1.5], 2, 1, "s"), (970, [1e30] * 24, 1, 1, "s")]
    return out + [out[0], out[0], (10, [2.0] * 24, 0, 1, "s")]


def test_all_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain(rows)
    assert len(want) > 500
    assert mined(df.repartition(3)) == want
    assert mined(df.coalesce(1).orderBy(F.rand(1))) == want


def test_many_blocks_and_batches(spark, rows, monkeypatch):
    monkeypatch.setattr(pca_negatives, "BLOCK", 50)
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_large_numbers_and_few_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(np.float32(x)) for x in rng.standard_normal(3) * 3e4], k % 2, 1, "s") for k in range(60)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain(rows)
    for n in (0, 1, 2, 5):
        assert mined(spark.createDataFrame(rows[:n], SCHEMA)) == plain(rows[:n])


def test_bounds_hold_for_any_rotation():
    """However bad the frame, no pair that is asked for is discarded."""
    rng = np.random.default_rng(6)
    v = np.floor(256 * rng.standard_normal((80, 40)))
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    for t in (None, turn):
        f = pca_negatives.Frame(v, t)
        for limit in (-1e5, 0.0, 2e5):
            i, j = pca_negatives.survivors(f, f, np.ones((80, 80), bool), lambda low, high, limit=limit: np.full(80, limit))
            assert {(a, b) for a, b in np.argwhere(v @ v.T >= limit).tolist()} <= set(zip(i.tolist(), j.tolist(), strict=True))


@pytest.mark.parametrize("planted", [False, True])
def test_query_equals_its_sql(spark, tmp_path, planted):
    folder = "/root/testdata/sf0.001"
    if planted:
        rng = np.random.default_rng(8)
        v = [[float(np.float32(x)) for x in rng.standard_normal(16)] for _ in range(700)]
        v += [v[100]] * 50 + [None, [0.0] * 16]
        pq.write_table(pa.table({"vec_id": pa.array(range(len(v)), pa.int64()), "embedding": pa.array(v, pa.list_(pa.float32())), "label": pa.array([None if k % 31 == 0 else k % 10 for k in range(len(v))], pa.int32())}), tmp_path / "embeddings.parquet")
        folder = str(tmp_path)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet'")
    cur = con.execute(oracle_sql()["op12_pca_negatives"])
    df = queries()["op12_pca_negatives"](spark, folder)
    assert df.columns == [c[0] for c in cur.description]
    want = Counter(cur.fetchall())
    assert want and Counter(map(tuple, df.collect())) == want
