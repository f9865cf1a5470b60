"""Personal data: base spans against plain scans of the contract's patterns, added ones on planted text, odd rows."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest

from sheetgraph.llm import pii
from sheetgraph.llm.queries import oracle_sql, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    """Base spans by re, as (start, place of kind, end)."""
    out = []
    for place, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")), "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]()
            if ok:
                out.append((m.start(), place, m.end()))
    return sorted(out)


def said(spans):
    return ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in spans)


def noisy(n, seed):
    rng = random.Random(seed)
    bits = ["a.b", "@", "x-1", ".", "c", " ", "-", "+", "1", "255", "256", "00", "4111 1111 1111 1111", "é", "🙂", "\n", "(", ")", "192.168.0.1", "+49 30 1234567", "u@v.w", "%", "tel ", "card ", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO9386011117947", "030 1234567", "invoice ", "5105105105105100", "_", "="]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 60))) for _ in range(n)]


ROWS = [(None, "no id: a@b.c"), (1, None), (2, ""), (3, "a@b.c"), (3, "a@b.c"), (4, "1 2" * 800), (5, "a." * 800 + "@" + "b." * 800), (6, "9" * 2000), (7, "1.2.3.4 " * 500), (8, "@" * 2000), (9, "+" * 2000), (10, "a" * 3000), (11, "4" + " 4" * 14)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = ROWS + [(100 + k, t) for k, t in enumerate(noisy(1500, 3))]
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, spans string, start int").repartition(4).cache()


def test_base_spans(docs):
    got = Counter((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.digest(pii.find(docs)).collect())
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        own = plain(r.text or "")
        want[r.doc_id, hashlib.sha256(said(own).encode()).hexdigest(), *(sum(k == x for _, k, _ in own) for x in range(4))] += 1
    assert got == want


def test_all_spans(docs):
    """Base spans stay; none of `tel` and `pan` overlaps another span; the places hold what the kind says."""
    kinds = Counter()
    for r in pii.find(docs).select("text", "spans", "start").collect():
        text, spans = r.text or "", r.spans
        assert [(s.start, pii.KINDS.index(s.kind), s.end) for s in spans if s.kind in pii.BASE] == plain(text)
        assert [(s.start, pii.KINDS.index(s.kind), s.end) for s in spans] == sorted((s.start, pii.KINDS.index(s.kind), s.end) for s in spans)
        strong = [(s.start, s.end) for s in spans if s.kind not in ("tel", "pan")]
        for s in spans:
            kinds[s.kind] += 1
            own = text[s.start : s.end]
            assert 0 <= s.score <= 1 and (s.kind in pii.BASE or s.score >= 0.6)
            if s.kind in ("tel", "pan") and len(text) < 5000:
                assert not any(a < s.end and s.start < b for a, b in strong)
            if s.kind == "iban":
                account = own.replace(" ", "")
                assert len(account) == pii.IBAN_LENGTHS[account[:2]] and int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1
    assert set(kinds) == set(pii.KINDS)


def test_context(spark):
    rows = [
        ("Tel. 030 1234567", "tel:5:16"),
        ("order 030 1234567", ""),
        ("tel of the order: 030 1234567", ""),
        ("visa 4222 2222 2222 2", "pan:5:21"),
        ("4222 2222 2222 2", ""),
        ("IBAN DE89 3704 0044 0532 0130 00 EUR", "iban:5:32"),
        ("DE88 3704 0044 0532 0130 00", ""),
        ("xDE89370400440532013000", ""),
        ("é GB82WEST12345698765432.", "iban:2:24"),
    ]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.digest(pii.find(df)).collect()}
    assert [got[k] for k in range(len(rows))] == [s for _, s in rows]
    text = [("call a@b.c or +1 (415) 555-1234 now",), (None,), ("clean",), ("1.2.3.4.5.6.7.8",)]
    assert [r.text for r in pii.redact(spark.createDataFrame(text, "text string").coalesce(1)).collect()] == ["call <email> or <phone> now", None, "clean", "<ip>.<ip>"]


def test_very_long_texts(spark):
    """Texts of hundreds of thousands of letters are read whole, in linear time."""
    rows = [("1 2" * 100_000, 0), ("a." * 200_000 + "@" + "b." * 200_000, 1), ("9" * 500_000, 0), ("1.2.3.4 " * 30_000, 30_000), ("@" * 100_000, 0), ("+" * 100_000, 0), ("a" * 1_000_000, 0), ("call 030 1234567, a@b.c; " * 5_000, 10_000)]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find(df).collect()}
    assert [len(got[k]) for k in range(len(rows))] == [n for _, n in rows]
    assert (got[1][0].start, got[1][0].end) == (0, 800_000) and got[3][-1].end == 8 * 30_000 - 1 and got[7][-2].kind == "tel"


def test_no_rows_and_no_python(spark, docs):
    found = pii.digest(pii.find(docs))
    assert not re.search("Python|Pandas|Arrow|Exchange", found._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0])
    assert pii.digest(pii.find(docs.limit(0))).count() == 0
    kept = pii.find(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_query_equals_its_sql(spark, tmp_path):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(ROWS + [(1000 + k, t) for k, t in enumerate(noisy(300, 5))], base.schema)
    base.unionByName(odd).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    cur = con.execute(oracle_sql()["op11_pii"])
    names = [c[0] for c in cur.description]
    df = queries()["op11_pii"](spark, str(tmp_path))
    assert df.columns == names
    assert Counter(map(tuple, df.collect())) == Counter(cur.fetchall())
