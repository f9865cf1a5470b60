"""The one operator that SQL can express, on the smallest tables and on planted links."""

from collections import Counter

import duckdb
import numpy as np

from sheetgraph.llm.queries import oracle_sql, queries


def _compare(spark, folder):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet'")
    cur = con.execute(oracle_sql()["op6_collision_join"])
    names = [c[0] for c in cur.description]
    expected = Counter(tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall())
    df = queries()["op6_collision_join"](spark, folder)
    assert sorted(df.columns) == sorted(names)
    assert Counter(tuple(r[c] for c in sorted(names)) for r in df.collect()) == expected
    return expected


def test_smallest_tables(spark):
    assert _compare(spark, "/root/testdata/sf0.001")


def test_planted_links(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = np.random.default_rng(2)
    base = rng.standard_normal((200, 32))
    rows = [*base, *[base[k % 5] + 0.1 * rng.standard_normal(32) for k in range(50)], *[base[7]] * 20]
    vectors = [[float(np.float32(x)) for x in v] for v in rows] + [None, [0.0] * 32]
    pq.write_table(pa.table({"vec_id": pa.array(range(len(vectors)), pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array([0] * len(vectors), pa.int32())}), tmp_path / "embeddings.parquet")
    found = _compare(spark, str(tmp_path))
    assert sum(1 for r in found if 0 in r) and len(found) > 50
