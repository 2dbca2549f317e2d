import hashlib
import math
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siftline.llm import multiset_hash as M


def brute(text):
    lanes = [0] * M.LANES
    for line in (text or "").split("\n"):
        digest = hashlib.sha256(line.encode()).hexdigest()
        for i in range(8):
            lanes[i] += int(digest[8 * i : 8 * i + 8], 16)
        words = [w for w in re.split("[\x20\x09-\x0d]+", line) if w]
        lanes[8] += 1
        lanes[9] += len(words)
        for a, b in zip(words, [*words[1:], None], strict=False):
            h = xxhash.xxh64_intdigest(a.encode(), 42)
            h = h if b is None else xxhash.xxh64_intdigest(b.encode(), h)
            for i in range(32):
                lanes[10 + 2 * i] += h >> i & 1
                lanes[11 + 2 * i] += h >> (i + 32) & 1
    return [x % (1 << 32) for x in lanes]


def brute_likeness(a, b):
    if a == b:
        return 1.0
    x, y = (np.array([2 * v - z[9] for v in z[10:]], float) for z in (a, b))
    norm = math.sqrt(x @ x) * math.sqrt(y @ y)
    return min(1.0, max(0.0, x @ y / norm)) if norm else 0.0


def text_of(lanes):
    return "".join(f"{x:08x}" for x in lanes)


def check(rows, got):
    ids = sorted({d for d, _ in rows if d is not None}, reverse=True) + [None] * any(d is None for d, _ in rows)
    signed = lambda t: xxhash.xxh64_intdigest(t.encode(), 42) - (1 << 64) * (xxhash.xxh64_intdigest(t.encode(), 42) >> 63)
    stands = {d: min((t or "" for e, t in rows if e == d), key=signed) for d in ids}
    want = []
    for d, t in rows:
        t = t or ""
        following = stands[ids[(ids.index(d) + 1) % len(ids)]]
        k = len(t) // 3
        edited = t[: len(t) - k] + following[:k]
        a, b, c = brute(t), brute(edited), brute(following)
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), text_of(a), text_of(b), brute_likeness(a, b), brute_likeness(a, c)))
    order = lambda r: (r[0] is not None, r[0] or 0, r[3])
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], abs=1e-9)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = M.edits(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], got)
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.95
    assert np.mean([r.near_edited for r in got]) > np.mean([r.near_next for r in got]) + 0.4


def test_edge_cases(spark):
    rows = [(5, None), (4, ""), (3, "\n\n"), (2, "one"), (2, "é😀 two\r\nthree  four"), (None, "no id"), (1, "x " * 30000), (9, "abc def ghi\nabc def ghi"), (9, "abc def ghi\nabc def ghi")]
    docs = spark.createDataFrame([(*r, 7, "clash") for r in rows], "doc_id long, text string, n_chars int, fingerprint string").repartition(3)
    check(rows, M.edits(docs).collect())
    check(rows[3:4], M.edits(docs.filter("doc_id = 2 AND text = 'one'")).collect())
    assert M.edits(docs.limit(0)).count() == 0


def test_homomorphism(spark):
    docs = spark.createDataFrame([("ab", "one two\nthree"), ("ba", "three\none two"), ("a", "one two"), ("b", "three")], "id string, text string")
    prints = {r.id: r for r in M.fingerprint(docs, ["id"]).collect()}
    assert prints["ab"].packed == prints["ba"].packed != prints["a"].packed
    pair = spark.createDataFrame([(prints["a"].packed, prints["b"].packed, prints["ab"].packed)], "a array<long>, b array<long>, ab array<long>")
    row = pair.select((M.insert(F.col("a"), F.col("b")) == F.col("ab")).alias("put"), (M.delete(F.col("ab"), F.col("b")) == F.col("a")).alias("taken")).first()
    assert row.put and row.taken
