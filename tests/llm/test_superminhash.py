import random
import re

import numpy as np
import pytest

from siftline.llm import near_copies, superminhash
from siftline.llm.superminhash import PLACES, band_keys, signatures


def plain_signature(hashes):
    """The signature of one set, element by element with a permutation array of its own."""
    best = [None] * PLACES
    for h in hashes:
        order = list(range(PLACES))
        for rank in range(PLACES):
            at, offer = superminhash._draw(np.array([h], np.uint64), rank, PLACES)
            order[rank], order[at[0]] = order[at[0]], order[rank]
            if best[order[rank]] is None or offer[0] < best[order[rank]]:
                best[order[rank]] = offer[0]
    return best


def test_signatures_against_one_element_at_a_time():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, n, np.uint64)) for n in (1, 2, 0, 30, 700, 3)]
    got = signatures(np.concatenate(sets), np.array([len(s) for s in sets]))
    for s, row in zip(sets, got, strict=True):
        assert row.tolist() == (plain_signature(s) if len(s) else [int(superminhash._EMPTY)] * PLACES)
    assert all(sorted(int(x) >> 40 for x in got[0]) == list(range(PLACES)) for _ in [0])  # one element: each rank once


@pytest.mark.parametrize("n", [10, 90, 900])
def test_equal_places_estimate_the_similarity(n):
    rng = np.random.default_rng(n)
    estimates = []
    for _ in range(60):
        x = rng.integers(0, 1 << 63, 10 * n // 9, np.uint64)
        pair = [x[: len(x) - n // 9], x[n // 9 :]]
        a, b = signatures(np.concatenate(pair), np.array([len(p) for p in pair]))
        estimates.append((a == b).mean())
    want = (len(x) - 2 * (n // 9)) / len(x)
    assert abs(np.mean(estimates) - want) < 0.02
    assert np.var(estimates) < want * (1 - want) / PLACES * (0.7 if n < 20 else 1.3)  # plain MinHash has 1, small sets half of it


def test_bands_bring_pairs_of_the_least_similarity_together():
    rng = np.random.default_rng(2)
    for n in (9, 45, 450):
        for _ in range(60):
            x = rng.integers(0, 1 << 63, 10 * n // 9, np.uint64)
            pair = [x[: len(x) - n // 9], x[n // 9 :]]
            a, b = band_keys(signatures(np.concatenate(pair), np.array([len(p) for p in pair])))
            assert (a == b).any()


def brute(rows):
    """(id, set size, smallest id reachable, kept) by comparing all pairs."""
    sets = []
    for _, t in rows:
        ws = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in t or "")) if w]
        sets.append({" ".join(ws[i : i + 2]) for i in range(max(1, len(ws) - 1))} if ws else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    edited = 0
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                up[root(i)] = root(j)
                edited += x != y
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    component = [d if not s else least.get(root(i)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]
    return [(d, len(s), c, d == c) for (d, _), s, c in zip(rows, sets, component, strict=True)], edited


KEY = lambda r: tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("members", [near_copies.MEMBERS_PER_TASK, 7])
def test_groups_against_all_pairs(spark, members):
    rng = random.Random(11)
    word = lambda: f"W{rng.randrange(3000)}é"
    rows = [(None, None), (1000, ""), (1001, " \n "), (1002, "Solo"), (1003, "solo"), (1004, "solo solo"), (None, "no id here"), (None, "No  ID here"), (1005, "with an id"), (None, "with an ID"), (1006, "a\x0bb\x0cc"), (1007, "a b c"), (1008, " a b"), (1009, "x y " * 40_000), (1010, "x y " * 50_000)]
    passage = [word() for _ in range(60)]
    for _ in range(30):
        text = [word() for _ in range(rng.choice([1, 2, 5, 30, 300]))] + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.choice([1, 3, 9])):
            rows.append((len(rows), " ".join(text)))
            for _ in range(rng.randrange(1 + len(text) // 12)):
                text[rng.randrange(len(text))] = word()
    drift = [word() for _ in range(100)]
    for _ in range(60):  # links of neighbours alone
        drift[rng.randrange(100)] = word()
        rows.append((len(rows), " ".join(drift)))
    rows += [rows[40]] * 3
    rng.shuffle(rows)
    want, edited = brute(rows)
    docs = spark.createDataFrame([(*r, 1, "k", 0) for r in rows], "doc_id long, text string, n int, key string, label int").repartition(4)
    got = [tuple(r) for r in near_copies.near_duplicates(docs, members_per_task=members).collect()]
    assert sorted(got, key=KEY) == sorted(want, key=KEY) and edited > 40


def test_empty_table(spark):
    assert near_copies.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
