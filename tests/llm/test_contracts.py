"""The registered queries: what they return for the tables of a folder, odd rows included."""

import hashlib
import math
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from sheetgraph.llm.common import table
from sheetgraph.llm.queries import queries

COLUMNS = {
    "op3_lbl_nce": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op4_mil_quality": "doc_id held_out score predicted",
    "op5_nnls_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op7_toxic_grammar": "doc_id held_out score predicted matched_clauses",
    "op8_simhash": "doc_id fingerprint component_id",
    "op9_rendezvous": "doc_id size text_crc32 law shard slot grown_shard",
    "op10_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
}
FOLDS = {"op3_lbl_nce": (5, 1), "op4_mil_quality": (4, 2), "op7_toxic_grammar": (5, 0)}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("tables")
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame([(900001, None, "en", "x"), (900002, "", "en", "x"), (900003, "Ünï \u0958 <|endoftext|>", "de", "x"), (900003, "Ünï \u0958 <|endoftext|>", "de", "x")], docs.schema)
    docs.limit(120).unionByName(odd).coalesce(3).write.parquet(f"{out}/documents.parquet")
    table(spark, "/root/testdata/sf0.001", "labels").write.parquet(f"{out}/labels.parquet")
    return str(out)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, folder, name):
    df = queries()[name](spark, folder)
    docs = [(r.doc_id, r.text or "") for r in table(spark, folder, "documents").collect()]
    assert df.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
    rows = df.collect()
    ids = Counter(r.doc_id for r in rows)
    assert ids.keys() == {d for d, _ in docs}
    if name != "op5_nnls_packing":
        assert ids == Counter(d for d, _ in docs)
    if name in FOLDS:
        m, k = FOLDS[name]
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % m == k) for r in rows)
    if "predicted" in df.columns:
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= (0.7 if name[2] == "4" else 0.5)) for r in rows)
    if name == "op8_simhash":
        assert all(len(r.fingerprint) == 16 and r.fingerprint == r.fingerprint.lower() and r.component_id <= r.doc_id for r in rows)
    if name == "op10_byte_bpe":
        assert Counter((r.doc_id, r.decoded_sha256) for r in rows) == Counter((d, hashlib.sha256(t.encode()).hexdigest()) for d, t in docs)


def test_nothing_moves_but_into_the_new_shard(spark, folder):
    """Sizes, checksums, shards and slots by a plain version of the hashing; sizes by SQL as well."""
    rows = queries()["op9_rendezvous"](spark, folder).collect()

    def shard(key, n):
        h = [xxhash.xxh64_intdigest(struct.pack("<i", s), seed=xxhash.xxh64_intdigest(f"k{key}".encode(), seed=42)) for s in range(n)]
        return min((-math.log(((x >> 12) + 0.5) / 2**52), s) for s, x in enumerate(h))[1]

    docs = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in table(spark, folder, "documents").collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == docs
    assert {r.law for r in rows} == {"key"}
    assert all((r.shard, r.grown_shard) in ((shard(r.doc_id, 8), shard(r.doc_id, 9)),) and r.grown_shard in (r.shard, 8) for r in rows)
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    con = duckdb.connect()
    got = con.execute(f"select doc_id, coalesce(octet_length(encode(text)), 0) + 1 from '{folder}/documents.parquet/*.parquet'").fetchall()
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter(got)


def test_pieces_and_sequences(spark, folder):
    rows = queries()["op5_nnls_packing"](spark, folder).collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    full = total = 0
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert 0 < at <= 2048
        total += at
        full += at if at & (at - 1) == 0 else 2048
    assert full <= 1.02 * total
    for d in {r.doc_id for r in rows} - {900003}:
        own = sorted((r.start, r.length) for r in rows if r.doc_id == d)
        assert [s for s, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist() and sum(n for _, n in own) == next(r.doc_tokens for r in rows if r.doc_id == d)
