import zlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from siftline.llm import jump_hash


def walk(key, shards):
    b, j = -1, 0
    key %= 1 << 64
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_known_walk():
    keys = np.array([0, 1, 2, 255, 10**12, 2**64 - 5, 12345678901234567], np.uint64)
    for n in (1, 2, 24, 25, 1000):
        assert jump_hash.jump(keys, n).tolist() == [walk(int(k), n) for k in keys]


def brute(rows, shards):
    rows = [(d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows]
    slot, out = Counter(), []
    for d, size, crc in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        s = walk(d or 0, shards)
        out.append((d, size, crc, "key", s, slot[s], walk(d or 0, shards + 1)))
        slot[s] += 1
    return Counter(out)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = jump_hash.place(docs, 24).collect()
    assert Counter(map(tuple, got)) == brute([(r.doc_id, r.text) for r in docs.collect()], 24)
    moved = [r for r in got if r.shard != r.grown_shard]
    assert all(r.grown_shard == 24 for r in moved) and 0 < len(moved) < 0.1 * len(got)


def test_edge_cases(spark):
    rows = [(None, "a"), (None, None), (-7, "x"), (5, ""), (5, ""), (5, "é" * 50000), (2**62, "big")] + [(11, "same")] * 500
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, shard string, slot int").repartition(4)
    assert Counter(map(tuple, jump_hash.place(docs, 24).collect())) == brute(rows, 24)
    assert jump_hash.place(docs.filter(F.lit(False)), 24).count() == 0


def test_keys_that_are_no_numbers(spark):
    """Text keys, numerals too, are hashed; a number that a key spells is not taken for it."""
    rows = [(None, "n"), ("", "e"), ("doc-é", "x"), ("17", "y"), ("doc-é", "x")] + [(f"https://a.example/{i}", "t") for i in range(400)]
    docs = spark.createDataFrame(rows, "`doc.id` string, text string").repartition(3)
    got = jump_hash.place(docs, 24, key_col="doc.id").collect()
    assert len(got) == len(rows)
    for r in got:
        key = 0 if r.doc_id is None else xxhash.xxh64_intdigest(r.doc_id.encode(), seed=42)
        assert (r.shard, r.grown_shard) == (walk(key, 24), walk(key, 25))
    for s in range(24):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
