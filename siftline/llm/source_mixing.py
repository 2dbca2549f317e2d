"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they count for). Each pattern can be repeated; its
k-th pass over the same tokens costs more than the one before (convex). A min-cost flow routes pattern tokens to
source quotas. A pattern's flow is then taken as whole passes over all its documents plus a seeded subset.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from siftline.llm.shared_storage import written

#: Membership patterns of overlapping sources that the driver solves for at most; they are a summary, not documents.
MAX_PATTERNS = 200_000
WORDS = r"[^\x20\x09-\x0D]+"
_HASH_DIGITS = 3


def min_cost_flow(capacity: dict[tuple, int], quota: dict, epochs: int = 3) -> dict[tuple, int]:
    """Tokens taken per pattern (a tuple of sources, each a possible recipient) so that quotas are met at least cost.

    Pass k of a pattern costs k per token (0, 1, ...), and nothing else costs anything. A path's cost is then that of the
    pass that it begins with, so the cheapest flow fills all of pass k before any of pass k + 1: each pass is opened for
    all patterns at once, and the flow is brought to its maximum before the next. Quotas that can't be met stay short.
    Ties go to the earlier pattern.
    """
    patterns, names = sorted(capacity, key=repr), sorted(quota, key=repr)
    place = {s: len(patterns) + i + 2 for i, s in enumerate(names)}
    graph: list[list[list[int]]] = [[] for _ in range(len(patterns) + len(names) + 2)]  # of [to, capacity, place of the reverse arc]

    def arc(a: int, b: int, cap: int) -> None:
        graph[a].append([b, cap, len(graph[b])])
        graph[b].append([a, 0, len(graph[a]) - 1])

    for i, p in enumerate(patterns, 2):
        arc(0, i, 0)
        for s in p:
            if s in place:
                arc(i, place[s], capacity[p] * epochs)
    for s in names:
        arc(place[s], 1, quota[s])
    for _ in range(epochs):
        for opened, p in zip(graph[0], patterns, strict=True):
            opened[1] += capacity[p]
        _fill(graph)
    return {p: capacity[p] * epochs - opened[1] for opened, p in zip(graph[0], patterns, strict=True)}


def _fill(graph: list[list[list[int]]]) -> None:
    """Bring the flow from node 0 to node 1 to its maximum, by blocking flows over the shortest paths that are open."""
    while True:
        level, queue = [0] + [-1] * (len(graph) - 1), [0]
        for a in queue:
            for b, cap, _ in graph[a]:
                if cap > 0 and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        if level[1] < 0:
            return
        tried = [0] * len(graph)
        while path := _open_path(graph, level, tried):
            push = min(graph[a][i][1] for a, i in path)
            for a, i in path:
                to, _, back = graph[a][i]
                graph[a][i][1] -= push
                graph[to][back][1] += push


def _open_path(graph: list[list[list[int]]], level: list[int], tried: list[int]) -> list[tuple[int, int]]:
    """Arcs (node, place) of one open path that rises a level at each; empty if there is none. ``tried`` skips dead ends."""
    path, a = [], 0
    while a != 1:
        if tried[a] == len(graph[a]):
            if not path:
                return []
            a, i = path.pop()
            tried[a] += 1
            continue
        b, cap, _ = graph[a][tried[a]]
        if cap > 0 and level[b] == level[a] + 1:
            path.append((a, tried[a]))
            a = b
        else:
            tried[a] += 1
    return path


def take(docs: DataFrame, taken: DataFrame, seed: str, narrow: DataFrame | None = None) -> DataFrame:
    """``docs`` (doc_id, size, pattern, ...) with ``times`` and ``taken`` long: passes and a seeded subset of each pattern.

    ``taken`` is (pattern, flow, capacity). Documents of a pattern are ordered by the MD5 of seed and id; the leading
    hash digits cut the pattern into blocks, and only the block in which the remainder runs out is ordered row by row.
    That document is taken if the sum then lies nearer to the flow. ``narrow`` may hold doc_id, size and pattern of
    the same rows, cheaper to sum.
    """
    md5 = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    hashed = docs.withColumn("_h", md5).withColumn("_block", F.substring("_h", 1, _HASH_DIGITS))
    narrow = (docs if narrow is None else narrow).withColumn("_block", F.substring(md5, 1, _HASH_DIGITS))
    quota = taken.select("pattern", F.when(F.col("capacity") > 0, F.floor(F.col("flow") / F.col("capacity"))).otherwise(0).cast("long").alias("_passes"), "flow", "capacity")
    quota = quota.withColumn("_rest", F.col("flow") - F.col("_passes") * F.col("capacity")).drop("flow", "capacity")
    sums = narrow.groupBy("pattern", "_block").agg(F.sum("size").alias("_sum"))  # 16 ** _HASH_DIGITS rows a pattern
    before = Window.partitionBy("pattern").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    cut = sums.join(quota, "pattern").filter("_before < _rest and _before + _sum >= _rest")
    cut = cut.groupBy("pattern").agg(F.min(F.struct("_block", "_before")).alias("c")).select("pattern", F.col("c._block").alias("_cut"), F.col("c._before").alias("_cut_before"))
    quota = written(quota.join(cut, "pattern", "left"), "mix-quotas")
    rows = hashed.join(quota, "pattern")
    inside = rows.filter(F.col("_block") == F.col("_cut"))
    order = Window.partitionBy("pattern").orderBy("_h", "doc_id", "size")
    # row_number breaks the ties of repeated rows, which are equal in every column that matters
    inside = inside.withColumn("_sum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("_cut_before"))
    over = F.col("_sum") - F.col("_rest")
    inside = inside.withColumn("_once", (over <= 0) | ((F.col("_sum") - F.col("size") < F.col("_rest")) & (over < F.col("size") - over)))
    outside = rows.filter(F.col("_cut").isNull() | (F.col("_block") != F.col("_cut"))).withColumn("_once", F.col("_cut").isNotNull() & (F.col("_block") < F.col("_cut")))
    both = outside.unionByName(inside.drop("_sum"))
    both = both.withColumn("times", F.col("_passes") + F.col("_once").cast("long"))
    return both.select(*docs.columns, "times", (F.col("size") * F.col("times")).alias("taken"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), limit: int = 3) -> DataFrame:
    """(source, source_size, target) of ``sizes`` (source, source_size): shares of the whole by repeating weights.

    Sources are ordered by code point, null last. A target stops at ``limit`` times its source's size; what is above
    goes to the others by weight. The sources whose targets stop are those with the least limit per weight, so one
    ordering of the sources settles it: each stops if its limit is below its share of what those before it left.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(every) - 1) % len(weights)) + 1).cast("double"))
    ranked = ranked.withColumn("_cap", (F.col("source_size") * limit).cast("double"))
    by_limit = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    share = left / (F.sum("_w").over(all_rows) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    ranked = ranked.withColumn("_share", share)
    ranked = ranked.withColumn("_stops", F.col("_cap") <= F.col("_share") * F.col("_w"))
    level = F.max(F.when(~F.col("_stops"), F.col("_share"))).over(all_rows)  # shares only fall after the first that doesn't stop
    return ranked.select("source", "source_size", F.when(F.col("_stops"), F.col("_cap")).otherwise(F.col("_w") * level).alias("target"))


def mix(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", epochs: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per row of ``docs``, each counting for its one source.

    Size is the number of words; a null text has none. A null source is a source of its own. Repeated rows stay and
    are taken on their own. An empty table, or one without words, takes nothing.
    """
    rows = written(docs.select(F.col(id_col).alias("doc_id"), _size(text_col).alias("size"), F.col(source_col).alias("source")), "mix-sizes")
    rows = rows.withColumn("pattern", F.array("source"))
    wanted, solved = _solved(rows, epochs)
    chosen = take(rows, solved, seed)
    out = chosen.join(wanted.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", epochs: int = 3) -> DataFrame:
    """The rows of ``docs`` as the mix repeats them: each as often as ``mix`` takes it, none if that is never."""
    plain = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    named = docs.withColumnsRenamed(plain)
    rows = named.withColumns({"doc_id": F.col(plain[id_col]), "size": _size(plain[text_col]), "source": F.col(plain[source_col])})
    sizes = written(rows.select("doc_id", "size", "source"), "mix-sizes")
    _, solved = _solved(sizes, epochs)
    chosen = take(rows.withColumn("pattern", F.array("source")), solved, seed, sizes.withColumn("pattern", F.array("source")))
    again = chosen.filter("times > 0").withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return again.select(*[F.col(name).alias(c) for c, name in plain.items()])


def _size(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long")


def _solved(rows: DataFrame, epochs: int) -> tuple[DataFrame, DataFrame]:
    """Targets of each source, and (pattern, flow, capacity) of the documents of each, for one source a document.

    Each source is then a graph of its own, so the flows are solved where the sources lie, however many there are.
    """
    wanted = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), limit=epochs), "mix-targets")
    schema = StructType([wanted.schema["source"], StructField("flow", LongType()), StructField("capacity", LongType())])
    solved = wanted.select("source", "source_size", F.floor(F.col("target") + 0.5).alias("quota")).mapInArrow(_flows(epochs), schema)
    return wanted, solved.select(F.array("source").alias("pattern"), "flow", "capacity")


def _flows(epochs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, size, quota = batch.columns
            each = zip(source.to_pylist(), size.to_pylist(), quota.to_pylist(), strict=True)
            flow = [min_cost_flow({(s,): n}, {s: q}, epochs)[(s,)] for s, n, q in each]
            yield pa.RecordBatch.from_arrays([source, pa.array(flow, pa.int64()), size], names=["source", "flow", "capacity"])

    return run


def mix_overlapping(docs: DataFrame, quotas: dict[str, int], seed: str = "mix", epochs: int = 3, max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """``docs`` (doc_id, size, sources array<string>) with ``taken``; a document counts for any one of its sources.

    ``quotas`` are words per source. Documents without a quoted source take nothing; null arrays count as empty and null
    sizes as zero. Other columns stay, whatever their names, but for one named ``taken``, which is replaced. Repeated
    rows stay and are taken on their own; an empty table stays empty. The graph of patterns is solved on the driver, so
    more than ``max_patterns`` of them raise.
    """
    spark = docs.sparkSession
    names = F.array(*[F.lit(s) for s in sorted(quotas)]).cast("array<string>")
    docs = docs.drop("taken")
    plain = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    named = docs.withColumnsRenamed(plain)
    pattern = F.array_sort(F.array_intersect(F.coalesce(F.col(plain["sources"]), F.array().cast("array<string>")), names))
    rows = named.withColumns({"doc_id": F.col(plain["doc_id"]), "size": F.coalesce(F.col(plain["size"]), F.lit(0)).cast("long"), "pattern": pattern})
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("n")).limit(max_patterns + 1).collect()  # a row per pattern
    if len(sums) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    capacity = {tuple(r.pattern): r.n for r in sums}
    flow = min_cost_flow(capacity, quotas, epochs)
    solved = spark.createDataFrame([(list(p), flow[p], n) for p, n in capacity.items()], "pattern array<string>, flow long, capacity long")
    return take(rows, solved, seed).select(*[F.col(name).alias(c) for c, name in plain.items()], "taken")


def shared_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, sources): each text once, under its smallest id, with all sources that hold it.

    Texts are told apart by their SHA-256; null counts as empty. A source is named "=" and its name, a null one "null".
    What is kept of a text's copies is a set of sources, combined before the shuffle. An empty table stays empty.
    """
    source = F.when(F.col(source_col).isNull(), "null").otherwise(F.concat(F.lit("="), F.col(source_col)))
    rows = docs.select(F.col(id_col).alias("doc_id"), _size(text_col).alias("size"), source.alias("source"), F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("t"))
    return rows.groupBy("t").agg(F.min("doc_id").alias("doc_id"), F.max("size").alias("size"), F.array_sort(F.collect_set("source")).alias("sources")).drop("t")


def mix_shared(docs: DataFrame, seed: str = "mix", epochs: int = 3, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """``shared_texts`` of ``docs`` with ``taken``: a text in several sources may fill the quota of any of them.

    A source's quota is its target by ``weights`` among the words of its texts, rounded; a row per source and per set
    of sources reaches the driver.
    """
    texts = written(shared_texts(docs), "mix-shared")
    sizes = texts.select("size", F.explode("sources").alias("source")).groupBy("source").agg(F.sum("size").alias("source_size"))
    quotas = {r.source: int(r.target + 0.5) for r in targets(sizes, weights, epochs).collect()}  # a row per source
    return mix_overlapping(texts, quotas, seed, epochs)
