import random

import pytest

import corpus_pipeline
from siftline.llm import near_copies

SF = "/root/testdata/sf0.01"


def brute(rows):
    """Smallest id of each component of pairs whose five-word sets have a Jaccard similarity of 0.8, and the pairs."""
    sets = []
    for _, t in rows:
        ws = "".join(c.lower() if c.isascii() else c for c in t or "").replace("\x0b", " ").replace("\x0c", " ")
        ws = [w for w in __import__("re").split("[\x20\x09-\x0d]+", ws) if w]
        sets.append(frozenset(" ".join(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))) if ws else frozenset())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    edited = 0
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x == y or 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
                up[root(i)] = root(j)
                edited += x != y
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return sorted(least.values()), edited


def test_edited_copies_in_the_pipeline_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want, edited = brute([(r.doc_id, r.text) for r in docs.collect()])
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns and edited >= 5
    assert sorted(r.doc_id for r in kept.collect()) == want


@pytest.mark.parametrize("members", [near_copies.MEMBERS_PER_TASK, 5])
def test_edits_near_the_bound_chains_and_shared_passages(spark, members):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(5000)}"
    rows, passage = [], [word() for _ in range(40)]
    for _ in range(40):
        text = [word() for _ in range(rng.choice([1, 4, 5, 6, 30, 200]))] + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.choice([1, 2, 6])):
            rows.append((len(rows), " ".join(text)))
            for _ in range(rng.randrange(5)):
                text[rng.randrange(len(text))] = word()
    rng.shuffle(rows)
    want, edited = brute(rows)
    kept = near_copies.one_per_group(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), members_per_task=members)
    assert sorted(r.doc_id for r in kept.collect()) == want and edited > 20


def test_drifting_copies_of_one_text(spark):
    rng = random.Random(3)
    text, rows = [f"w{rng.randrange(5000)}" for _ in range(120)], []
    for i in range(300):
        text = list(text)
        for _ in range(rng.choice([1, 1, 3, 9])):
            text[rng.randrange(len(text))] = f"w{rng.randrange(5000)}"
        rows.append((i, " ".join(text)))
    rng.shuffle(rows)
    want, edited = brute(rows)
    kept = near_copies.one_per_group(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), members_per_task=16)
    assert sorted(r.doc_id for r in kept.collect()) == want and edited > 200 and len(want) > 1


def test_edge_cases(spark):
    rows = [(3, None), (9, ""), (5, " \t\n"), (None, "one two three"), (8, "One  two\nthree"), (8, "One  two\nthree"), (7, "solo"), (2, "word " * 60000), (1, "WORD " * 40000)]
    docs = spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in rows], "doc_id long, text string, body string, n int, _h int, _id int")
    kept = near_copies.one_per_group(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 7, 8]
    assert near_copies.one_per_group(docs.limit(0)).count() == 0
