import math
from collections import Counter

import duckdb
import pytest

from siftline.llm import queries, stupid_backoff


def brute(rows):
    pairs = []
    for _, t in rows:
        ws = "".join(c.lower() if c.isascii() else c for c in t or "").replace("\x0b", " ").replace("\x0c", " ")
        ws = [w for w in __import__("re").split("[\x20\x09-\x0d]+", ws) if w]
        pairs.append(Counter(zip(["", *ws], [*ws, ""], strict=True)) if ws else Counter())
    both, one, two = Counter(), Counter(), Counter()
    for p in pairs:
        both.update(p)
        for (a, b), n in p.items():
            one[a] += n
            two[b] += n
    total, out = sum(one.values()), []
    for (d, _), p in zip(rows, pairs, strict=True):
        s, back = 0.0, 0
        for (a, b), n in p.items():
            others = both[a, b] - n
            s += n * (math.log10(others / one[a]) if others else math.log10(0.4 * two[b] / total))
            back += n * (not others)
        out.append((d, sum(p.values()), back, s / sum(p.values()) if p else None))
    return out


def same(got, want):
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert g[:3] == w[:3] and (g[3] == w[3] is None or g[3] == pytest.approx(w[3], abs=2e-6))


@pytest.mark.parametrize("ranked,hot,row", [(1 << 16, 64, 1 << 16), (512, 4, 50)])
def test_documents(spark, monkeypatch, ranked, hot, row):
    monkeypatch.setattr(stupid_backoff, "RANKED", ranked)
    monkeypatch.setattr(stupid_backoff, "HOT", hot)
    monkeypatch.setattr(stupid_backoff, "_PAIRS_A_ROW", row)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    same(stupid_backoff.scores(docs).collect(), brute([(r.doc_id, r.text) for r in docs.collect()]))


def test_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    want = con.sql(queries.ORACLES["op6_stupid_backoff"]).fetchall()
    same(stupid_backoff.scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect(), want)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b c"), (4, "a b c"), (4, "other text"), (None, "A  B\tz"), (5, "w " * 100000), (6, "w w w é"), (7, "solo")]
    docs = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, key string, n int")
    same(stupid_backoff.scores(docs).collect(), brute(rows))
    assert stupid_backoff.scores(docs.limit(0)).count() == 0
    same(stupid_backoff.scores(docs.filter("doc_id < 4")).collect(), brute(rows[:3]))
