import math
import random

import numpy as np
import pytest

from siftline.llm import dual_tree

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100):
    one = {}
    for i, x, label in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        r = (label, [math.floor(256 * float(np.float32(v))) for v in x])
        one[i] = min(one.get(i, r), r)
    score = lambda a, b: sum(x * y for x, y in zip(one[a][1], one[b][1], strict=False))
    out = []
    for a in one:
        if a % every:
            continue
        others = sorted(((-score(a, b), b) for b in one if b != a))
        same = [(-s, b) for s, b in others if one[b][0] == one[a][0]][:5]
        rest = [(-s, b) for s, b in others if one[b][0] != one[a][0]]
        for ps, p in same:
            hit = [(s, b) for s, b in rest if 30 * ps <= 100 * s <= 90 * ps][:10]
            out += [(a, p, n, b, ps, s) for n, (s, b) in enumerate(hit, 1)]
    return sorted(out)


def table(n, seed, dims=8, labels=4, tight=0.5):
    rng = random.Random(seed)
    centre = [rng.gauss(0, 0.3) for _ in range(dims)]
    rows = []
    for i in range(n):
        near = rng.random() < tight
        x = [c + rng.gauss(0, 0.02) for c in centre] if near else [rng.gauss(0, 0.3) for _ in range(dims)]
        rows.append((i, x, rng.randrange(labels)))
    return rows


def mined(spark, rows, **how):
    return sorted(map(tuple, dual_tree.mine(spark.createDataFrame(rows, KIND), **how).collect()))


def test_against_brute_force(spark):
    rows = table(1500, 1)
    rows += [(1500 + i, rows[0][1], i % 3) for i in range(60)]  # copies of an anchor
    rows += [(1600, [0.5] * 8, None), (1700, None, 1), (1800, [0.1, None] * 4, 1), (1900, [float("nan")] * 8, 1), (2000, [float("inf")] * 8, 2), (None, [0.1] * 8, 1)]
    rows += [(2100, [], 1), (2200, [0.4, -0.2], 2), (2300, [0.0] * 8, 3), (2400, [-0.3] * 8, 99)]
    rows += [rows[3], rows[3], (5, [0.9] * 8, 0)]  # repeated, and one id twice
    want = brute(rows)
    assert len(want) > 500
    assert mined(spark, rows, page_rows=100, anchor_rows=4, leaf_rows=64) == want
    clashing = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], KIND + ", leaf int, page string, score double")
    assert sorted(map(tuple, dual_tree.mine(clashing).collect())) == want


@pytest.mark.parametrize("rows", [[], [(0, [0.1], 1)], [(100, [0.1], 1), (1, [0.1], 2)], [(0, None, 1)]])
def test_too_few_rows(spark, rows):
    assert mined(spark, rows) == []


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [0.5, 0.5], i % 2) for i in range(0, 400, 5)]
    assert mined(spark, rows, page_rows=7, leaf_rows=8) == brute(rows)
    rows = [(i, [0.5 if i % 3 else 0.3, 0.5], i % 2) for i in range(1, 401)]
    got = mined(spark, rows, page_rows=7, leaf_rows=8)
    assert got == brute(rows) and got


def test_scores_beyond_doubles_are_refused(spark):
    with pytest.raises(ValueError, match="too large"):
        mined(spark, [(0, [1e9, 1.0], 1), (1, [1.0, 1.0], 1)])


def test_pruned_pairs_hold_nothing_that_is_needed():
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.normal(c, 5, (200, 6)) for c in rng.normal(0, 200, (8, 6))])
    tree = dual_tree.halved(rows[::3], 4)
    leaf = tree.leaves(rows)
    anchor = np.arange(len(rows)) % 9 == 0
    away, norm = np.linalg.norm(rows - tree.centre[15 + leaf], axis=1), np.linalg.norm(rows, axis=1)

    def of(part):
        at = [part & (leaf == i) for i in range(16)]
        return dual_tree.balls(tree, np.array([a.sum() for a in at]), np.array([away[a].max(initial=0) for a in at]), np.array([norm[a].max(initial=0) for a in at]))

    scores = rows @ rows.T
    low, high = np.percentile(scores, 97), np.percentile(scores, 99)
    a, c = dual_tree.surviving(tree, of(anchor), of(np.ones(len(rows), bool)), np.full(16, low), np.full(16, high))
    kept = set(zip(a.tolist(), c.tolist(), strict=True))
    i, j = np.nonzero(anchor[:, None] & (scores >= low) & (scores <= high))
    assert set(zip(leaf[i].tolist(), leaf[j].tolist(), strict=True)) <= kept
    assert len(kept) < 128  # of 256
