import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siftline.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, component string"


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= 3:
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, least.get(root(i))) for i, (d, _) in enumerate(prints)]


def test_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {d: (f"{fp:016x}", c) for (d, fp), (_, c) in zip(prints, brute_components(prints), strict=True)}
    assert len({c for _, c in got.values()}) < len(got)


@pytest.mark.parametrize("homes", [4096, 7])
def test_links_keep_every_component(spark, homes):
    rng = random.Random(5)
    fps = set()
    for _ in range(60):
        at = rng.getrandbits(64)
        fps.add(at)
        for _ in range(rng.choice([0, 1, 4, 60])):
            at2 = at
            for _ in range(rng.choice([1, 2, 3, 4])):
                at2 ^= 1 << rng.randrange(64)
            fps.add(at2)
            if rng.random() < 0.2:
                at = at2
    fps = sorted(fps)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(5), homes_per_task=homes)
    labels = {r.node: r.label for r in simhash.connected(edges).collect()}
    want = brute_components(list(zip(signed, fps, strict=True)))
    assert {d: labels.get(d, d) for d in signed} == dict(want)
    for r in edges.collect():
        assert labels[r.a] == labels[r.b]


def test_edge_cases(spark):
    rows = [
        (3, None, "en", "a", 0, "x", "y"), (9, "", "en", "a", 0, "x", "y"), (5, " \t\n", None, None, None, None, None),
        (None, "one two three four five", "en", "a", 1, "x", "y"), (8, "One  two three\nfour five", "en", "a", 1, "x", "y"),
        (8, "One  two three\nfour five", "en", "a", 1, "x", "y"), (7, "solo", "en", "a", 1, "x", "y"),
        (2, "word " * 60000, "en", "a", 1, "x", "y"), (1, "WORD " * 40000, "en", "a", 1, "x", "y"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, 8), (1, 1), (2, 1), (3, 3), (5, 3), (7, 7), (8, 8), (8, 8), (9, 3)]
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 7, 8]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.one_per_group(docs.filter(F.lit(False))).count() == 0


def test_one_row_of_groups_without_ids_and_clashing_names(spark):
    rows = [(None, "one two three", 5, 1), (None, "One two  three", 4, 1), (2, "other words here", 3, 1), (2, "other words here", 1, 1), (2, "other words here", 2, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _h int, _id int")
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    got = sorted(kept.collect(), key=lambda r: r.doc_id or 0)
    assert [r.doc_id for r in got] == [None, 2] and got[1]["_h"] == 1
