import itertools
import random
import re
import time
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from siftline.llm import queries, source_mixing

SCHEMA = "doc_id long, text string, lang string, source string, target string"


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        w = sum(weight[s] for s in names if s not in stopped)
        target = {s: 3.0 * sizes[s] if s in stopped else left * weight[s] / w for s in names}
        above = {s for s in names if target[s] > 3 * sizes[s] + 1e-9}
        if not above:
            return target
        stopped |= above


def check(rows, got):
    sizes, size_of = defaultdict(int), lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    for _, t, s in rows:
        sizes[s] += size_of(t)
    want = brute_targets(sizes)
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((d or -1, size_of(t)) for d, t, _ in rows)
    taken, biggest, source = defaultdict(int), defaultdict(int), {d: s for d, _, s in rows}
    for r in got:
        assert r.taken % max(1, r.size) == 0 and 0 <= r.taken <= 3 * r.size
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
        biggest[source[r.doc_id]] = max(biggest[source[r.doc_id]], r.size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= biggest[s] / 2 + 1


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = source_mixing.mix(docs).collect()
    check([(r.doc_id, r.text, r.source) for r in docs.collect()], got)
    assert sorted(got) == sorted(source_mixing.mix(docs.repartition(7)).collect())
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    sql = con.sql("SELECT doc_id, size, source_size, target, taken FROM (" + queries.ORACLES["op9_source_mixing"] + ")").fetchall()
    assert sorted(sql) == sorted(tuple(r) for r in got)


def test_edge_cases(spark):
    rows = [(1, None, "b"), (2, "", "b"), (None, "one two", None), (3, "a b c", None), (4, "w " * 3000, "z"), (5, "w " * 10, "z")]
    rows += [(6, "x y", "é"), (6, "x y", "é"), (7, "x\x0by\xa0z q", "e")] + [(100 + i, "k " * (i % 7), "hot") for i in range(300)]
    docs = spark.createDataFrame([(d, t, None, s, "clash") for d, t, s in rows], SCHEMA)
    check(rows, source_mixing.mix(docs).collect())
    assert source_mixing.mix(docs.limit(0)).count() == 0
    assert {r.taken for r in source_mixing.mix(docs.filter("doc_id in (1, 2)")).collect()} == {0}


def test_min_cost_flow_repeats_least():
    flow = source_mixing.min_cost_flow({("a",): 10, ("a", "b"): 20, ("b",): 10}, {"a": 25, "b": 15})
    assert flow == {("a",): 10, ("a", "b"): 20, ("b",): 10}
    short = source_mixing.min_cost_flow({("a",): 5}, {"a": 100})
    assert short == {("a",): 15}
    twice = source_mixing.min_cost_flow({("a",): 10, ("a", "b"): 10}, {"a": 30, "b": 5})
    assert sum(twice.values()) == 35 and max(twice[("a",)], twice[("a", "b")]) <= 20


def test_overlapping(spark):
    rows = [(i, 1 + i % 5, [["a"], ["a", "b"], ["b", "a", "x"], None, []][i % 5]) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, size long, sources array<string>")
    got = source_mixing.mix_overlapping(docs, {"a": 1500, "b": 600}).collect()
    assert len(got) == 1000 and abs(sum(r.taken for r in got) - 2100) <= 6
    assert all(r.taken == 0 for r in got if not r.sources) and all(r.taken <= 3 * r.size for r in got)


def test_overlapping_keeps_clashing_columns(spark):
    rows = [(i, 2, ["a"], "h", "b", "p", 7, 8) for i in range(20)] + [(None, None, None, None, None, None, None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, size long, sources array<string>, _h string, _block string, pattern string, times long, taken long")
    out = source_mixing.mix_overlapping(docs, {"a": 30})
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == 22 and sum(r.taken for r in got) == 30
    assert all((r._h, r._block, r.pattern, r.times) == ("h", "b", "p", 7) for r in got if r.doc_id is not None)
    assert source_mixing.mix_overlapping(docs.limit(0), {"a": 30}).count() == 0


def test_many_sources_need_no_solver_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(source_mixing, "MAX_PATTERNS", 10)
    rows = [(i, "w " * (1 + i % 9), f"s{i % 500:03d}") for i in range(2000)]
    got = source_mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    check(rows, got)


def by_trying_all(capacity, quota, epochs):
    """(flow, -cost) of the cheapest among the largest flows, by trying every one."""
    patterns, best = sorted(capacity), (-1, 0)
    shares = [[(p, s) for s in p] for p in patterns]
    arcs = [a for x in shares for a in x]
    for amounts in itertools.product(*[range(min(quota[s], capacity[p] * epochs) + 1) for p, s in arcs]):
        into, out = defaultdict(int), defaultdict(int)
        for (p, s), n in zip(arcs, amounts, strict=True):
            into[s] += n
            out[p] += n
        if all(into[s] <= quota[s] for s in quota) and all(out[p] <= capacity[p] * epochs for p in patterns):
            cost = sum(k * min(capacity[p], max(0, out[p] - k * capacity[p])) for p in patterns for k in range(epochs))
            best = max(best, (sum(amounts), -cost))
    return best


def test_min_cost_flow_is_the_cheapest_of_the_largest():
    draw = random.Random(5)
    for _ in range(40):
        capacity = {p: draw.randrange(3) for p in [("a",), ("a", "b"), ("b",)]}
        quota = {"a": draw.randrange(6), "b": draw.randrange(6)}
        flow = source_mixing.min_cost_flow(capacity, quota, 3)
        cost = sum(k * min(capacity[p], max(0, n - k * capacity[p])) for p, n in flow.items() for k in range(3))
        assert (sum(flow.values()), -cost) == by_trying_all(capacity, quota, 3), (capacity, quota, flow)


def test_min_cost_flow_of_many_patterns_ends():
    names = [f"s{i}" for i in range(40)]
    draw = random.Random(7)
    capacity = {tuple(sorted(draw.sample(names, draw.randrange(1, 5)))): draw.randrange(1, 1000) for _ in range(20000)}
    quota = {s: sum(capacity.values()) // 40 for s in names}
    started = time.monotonic()
    flow = source_mixing.min_cost_flow(capacity, quota)
    assert time.monotonic() - started < 60
    assert sum(flow.values()) == sum(quota.values()) and all(n <= 3 * capacity[p] for p, n in flow.items())


def test_shared_texts_fill_quotas_of_any_of_their_sources(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    # every third text is held by a second source too
    more = docs.filter("doc_id % 3 = 0").select((F.col("doc_id") + 10**6).alias("doc_id"), "text", "lang", F.lit("mirror").alias("source"), "n_chars")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 6 < 5, F.concat(F.lit("s"), F.col("doc_id") % 6))).unionByName(more)
    where, first = defaultdict(set), {}
    for r in docs.collect():
        where[r.text or ""].add("null" if r.source is None else "=" + r.source)
        first[r.text or ""] = min(r.doc_id, first.get(r.text or "", r.doc_id))
    size = {t: len(re.findall("[^\x20\x09-\x0d]+", t)) for t in where}
    capacity, sizes = defaultdict(int), defaultdict(int)
    for t, s in where.items():
        capacity[tuple(sorted(s))] += size[t]
        for x in s:
            sizes[x] += size[t]
    assert len([p for p in capacity if len(p) > 1]) > 2
    names = {s: (s[1:] if s != "null" else None) for s in sizes}
    wanted = brute_targets({names[s]: n for s, n in sizes.items()})
    quota = {s: int(wanted[names[s]] + 0.5) for s in sizes}
    flow = source_mixing.min_cost_flow(dict(capacity), quota)
    got = source_mixing.mix_shared(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(first.values())
    taken, biggest = defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0
        taken[tuple(r.sources)] += r.taken
        biggest[tuple(r.sources)] = max(biggest[tuple(r.sources)], r.size)
    assert set(taken) <= set(capacity) and all(abs(taken[p] - flow[p]) <= biggest[p] for p in capacity)
    # the largest flow is the least cut
    least = min(sum(quota[s] for s in quota if s not in some) + sum(3 * c for p, c in capacity.items() if set(p) & set(some)) for n in range(len(quota) + 1) for some in itertools.combinations(sorted(quota), n))
    assert sum(flow.values()) == least
    assert source_mixing.mix_shared(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None, None), (2, "", "a"), (2, "", "a"), (None, "one two", None), (4, "one two", "null")], "doc_id long, text string, source string")
    assert {(r.doc_id, tuple(r.sources)) for r in source_mixing.shared_texts(odd).collect()} == {(1, ("=a", "null")), (4, ("=null", "null"))}
