"""Hard negatives by dual-tree search, with exact integer scores.

Two trees share one topology: repeated halvings of a bounded sample. Every row is put into a leaf by walking the
halvings; a ball around a node's fixed centre holds all rows below it, with radii of their own for anchors and for
candidates. Trees have fewer than 2 * MAX_LEAVES nodes however many rows there are, so descending from the pair of
roots is a small numpy job: where the interval of inner products of a pair of nodes can't reach what any anchor below
still needs, the pair goes with everything under it, all its anchors at once. The pairs of leaves that stay are scored
exactly: rows of a leaf lie in pages, the anchors' pages are dealt to the candidates' pages, and a task holds one
candidates' page and lets the anchors' pages pass.

What an anchor needs is known from a first search of its own leaf: its fifth positive there, and for each positive its
tenth negative, are scores below which nothing more is looked for. In data without structure the balls are wide and few
pairs go; the answer is the same, and each pair of pages is then scored once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.llm.shared_storage import written

#: Rows from which the halvings are learnt (twice as many at most), leaves of a tree, rows for which a leaf is made.
SAMPLE_ROWS, MAX_LEAVES, LEAF_ROWS = 8192, 512, 1024
#: Rows of a page of candidates and of anchors.
PAGE_ROWS, ANCHOR_ROWS = 4096, 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score in hundredths of the positive's.
LEAST, MOST = 30, 90
_LOW, _HIGH = -(1 << 62), 1 << 62
_PAGE = "leaf int, page int, ids array<long>, labels array<int>, vectors binary, bounds array<long>"


class Tree(NamedTuple):
    """Node n has the children 2n + 1 and 2n + 2; the last level are leaves, numbered from 0."""

    direction: np.ndarray
    cut: np.ndarray
    centre: np.ndarray

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        node, inner = np.zeros(len(rows), np.int64), len(self.cut)
        while inner and node.size and node[0] < inner:
            node = 2 * node + 1 + (np.einsum("ij,ij->i", rows, self.direction[node]) > self.cut[node])
        return node - inner


def halved(sample: np.ndarray, depth: int) -> Tree:
    """Each node is cut across the main direction of its part of ``sample``, at the median."""
    inner, dims = (1 << depth) - 1, sample.shape[1]
    tree = Tree(np.zeros((inner, dims)), np.zeros(inner), np.zeros((2 * inner + 1, dims)))
    groups = [np.arange(len(sample))]
    for node in range(2 * inner + 1):
        rows = sample[groups[node]]
        tree.centre[node] = rows.mean(0) if len(rows) else tree.centre[(node - 1) // 2] if node else 0
        if node >= inner:
            continue
        if len(rows):
            spread = rows - tree.centre[node]
            v = spread[(spread**2).sum(1).argmax()]
            for _ in range(8):
                v = spread.T @ (spread @ v)
                v = v / max(np.linalg.norm(v), 1e-300)
            tree.direction[node], tree.cut[node] = v, np.median(rows @ v)
        right = np.einsum("ij,j->i", rows, tree.direction[node]) > tree.cut[node]
        groups += [groups[node][~right], groups[node][right]]
    return tree


class Balls(NamedTuple):
    """Of each node of a tree: how many rows, their farthest distance from its centre, their longest norm."""

    rows: np.ndarray
    radius: np.ndarray
    norm: np.ndarray


def _upward(tree: Tree, leaf_values: np.ndarray, join) -> np.ndarray:
    """Values of all nodes from those of the leaves; ``join`` gets (node, value of its children) for both children."""
    inner = len(tree.cut)
    out = np.concatenate((np.zeros(inner), leaf_values.astype(float)))
    for node in range(inner - 1, -1, -1):
        out[node] = join(node, (2 * node + 1, 2 * node + 2), out)
    return out


def balls(tree: Tree, rows: np.ndarray, radius: np.ndarray, norm: np.ndarray) -> Balls:
    n = _upward(tree, rows, lambda _, kids, out: out[kids[0]] + out[kids[1]])
    reach = lambda node, kids, out: max([0.0, *(np.linalg.norm(tree.centre[node] - tree.centre[k]) + out[k] for k in kids if n[k])])
    return Balls(n, _upward(tree, radius, reach), _upward(tree, norm, lambda _, kids, out: max(out[k] for k in kids)))


def surviving(tree: Tree, anchors: Balls, candidates: Balls, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchors' leaf, candidates' leaf) of the pairs that may hold a score that is needed.

    ``low`` and ``high`` are, of each leaf, the least and the greatest score that any of its anchors has use for.
    """
    low = _upward(tree, low, lambda _, kids, out: min(out[k] for k in kids))
    high = _upward(tree, high, lambda _, kids, out: max(out[k] for k in kids))
    length, inner = np.linalg.norm(tree.centre, axis=1), len(tree.cut)
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        dot = np.concatenate([np.einsum("ij,ij->i", tree.centre[a[i : i + 8192]], tree.centre[b[i : i + 8192]]) for i in range(0, len(a), 8192)] or [np.empty(0)])
        slack = anchors.radius[a] * length[b] + candidates.radius[b] * length[a] + anchors.radius[a] * candidates.radius[b]
        slack = slack * (1 + 1e-9) + 1e-3  # rounding
        most = anchors.norm[a] * candidates.norm[b] * (1 + 1e-9) + 1e-3
        use = (anchors.rows[a] > 0) & (candidates.rows[b] > 0)
        use &= (np.minimum(dot + slack, most) >= low[a]) & (np.maximum(dot - slack, -most) <= high[a])
        a, b = a[use], b[use]
        if not len(a) or a[0] >= inner:
            return a - inner, b - inner
        a, b = (2 * a[:, None] + np.array([1, 1, 2, 2])).ravel(), (2 * b[:, None] + np.array([1, 2, 1, 2])).ravel()


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()].reshape(len(column), dims)


def _router(tree, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(2), dims)
            wide = rows.astype(float)
            leaf = tree.value.leaves(wide)
            away = np.linalg.norm(wide - tree.value.centre[len(tree.value.cut) + leaf], axis=1)
            packed = pa.array([r.tobytes() for r in rows.astype("<i4")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], packed, pa.array(leaf, pa.int32()), pa.array(away), pa.array(np.linalg.norm(wide, axis=1))], names=["vec_id", "label", "vector", "leaf", "away", "norm"])

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by the first two columns, a batch for each of their values."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        one, two = (batch.column(i).to_numpy() for i in range(2))
        cuts = np.flatnonzero((one[1:] != one[:-1]) | (two[1:] != two[:-1])) + 1
        for s, e in zip([0, *cuts], [*cuts, len(one)], strict=True):
            if e > s:
                if (one[s], two[s]) != key and held:
                    yield pa.concat_batches(held)
                    held = []
                key = (one[s], two[s])
                held.append(batch.slice(s, e - s))
    if held:
        yield pa.concat_batches(held)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (leaf, page, vec_id, label, vector, bounds) to a row for each page."""
    for page in _groups(batches):
        whole = lambda c: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c)
        bounds = page.column(5)
        flat = bounds.values[bounds.offsets[0].as_py() : bounds.offsets[-1].as_py()]
        yield pa.RecordBatch.from_arrays(
            [page.column(0)[:1], page.column(1)[:1], whole(page.column(2)), whole(page.column(3)), pa.array([b"".join(page.column(4).to_pylist())], pa.binary()), whole(flat)],
            names=["leaf", "page", "ids", "labels", "vectors", "bounds"],
        )


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's first k finite scores by (score descending, id)."""
    open_rows = np.flatnonzero((scores > -np.inf).any(1))
    part = scores[open_rows]
    use = part > -np.inf
    if part.shape[1] > k:
        use &= part >= np.partition(part, part.shape[1] - k, axis=1)[:, -k][:, None]
    i, j = np.nonzero(use)
    order = np.lexsort((ids[j], -part[i, j], i))
    i, j = i[order], j[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    return open_rows[i[place < k]], j[place < k]


def _scorer(dims: int, same: bool, k: int):
    """Pages (leaf, page, kind, ids, labels, vectors, bounds) of one place, that of candidates (kind 0) first, to
    (anchor_id, place, other_id, score): for each window (low, high) of an anchor's bounds the best k rows of the same
    label, or of other labels."""

    def values(page: pa.RecordBatch, row: int) -> tuple[np.ndarray, ...]:
        ids, labels, bounds = (page.column(i)[row].values.to_numpy() for i in (3, 4, 6))
        return ids, labels, np.frombuffer(page.column(5)[row].as_py(), "<i4").reshape(len(ids), dims).astype(float), bounds.reshape(len(ids), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                now = (batch.column(0)[row].as_py(), batch.column(1)[row].as_py())
                if batch.column(2)[row].as_py() == 0:
                    key, held = now, values(batch, row)
                    continue
                if now != key:
                    continue  # its leaf has no candidates
                (cand, cand_labels, cand_rows, _), (ids, labels, rows, bounds) = held, values(batch, row)
                scores = rows @ cand_rows.T
                fits = ((labels[:, None] == cand_labels) == same) & (ids[:, None] != cand)
                for place in range(bounds.shape[1] // 2):
                    low, high = bounds[:, 2 * place, None], bounds[:, 2 * place + 1, None]
                    i, j = _best(np.where(fits & (scores >= low) & (scores <= high), scores, -np.inf), cand, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[i]), pa.array(np.full(len(i), place + 1, np.int32)), pa.array(cand[j]), pa.array(scores[i, j].astype(np.int64))],
                        names=["anchor_id", "place", "other_id", "score"],
                    )

    return run


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, q): a row for each id, components floor(256 * x); rows that take no part are gone."""
    x = F.col(vector_col)
    q = F.transform(x, lambda v: F.floor(v.cast("double") * 256.0))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    label = F.when(F.col(id_col) % 7 == 0, (F.col(label_col) + 1) % 10).otherwise(F.col(label_col)).cast("int")
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & finite)
    one = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.struct(label.alias("label"), q.alias("q")).alias("r"))
    return one.groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.q")


def mine(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 100, page_rows: int = PAGE_ROWS, anchor_rows: int = ANCHOR_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of anchors, ids divisible by ``every``.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Of rows that share an id
    the least by (label, components) stands for it, so repeated rows count once. A shorter vector is one whose further
    components are zero; an empty one scores zero with all. Ties go to the smaller id. An anchor without another row of
    its label has no rows, nor has a positive of negative score. Vectors whose inner products could pass 2**53, where
    doubles stop being exact, are refused with a ValueError. An empty table gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = written(quantised(vectors, id_col, vector_col, label_col), "quantised")
    dims, largest, n = rows.agg(F.max(F.size("q")), F.max(F.array_max(F.transform("q", F.abs))), F.count(F.lit(1))).first()
    dims = dims or 0
    if dims * (largest or 0) ** 2 >= 1 << 53:
        raise ValueError("components are too large for exact scores")
    width = max(dims, 1)
    rows = rows.withColumn("q", F.concat("q", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("q"))))
    sample = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, n // SAMPLE_ROWS))) == 0).select("q").toArrow()["q"].combine_chunks()  # bounded
    depth = min(max(n // leaf_rows, 1), MAX_LEAVES).bit_length() - 1
    tree = halved(_matrix(sample, width).astype(float) if len(sample) else np.zeros((0, width)), depth)
    routed = rows.select("vec_id", "label", "q").mapInArrow(_router(spark.sparkContext.broadcast(tree), width), "vec_id long, label int, vector binary, leaf int, away double, norm double")
    routed = written(routed, "routed")

    def leaves(part: DataFrame, a_page: int) -> tuple[Balls, DataFrame]:
        """Balls of the tree over ``part``, and its pages of each leaf: (leaf, pages)."""
        found = part.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("away"), F.max("norm").alias("norm")).collect()  # at most MAX_LEAVES
        held = np.zeros((3, 1 << depth))
        for r in found:
            held[:, r.leaf] = r.n, r.away, r.norm
        return balls(tree, *held), spark.createDataFrame([(r.leaf, -(-r.n // a_page)) for r in found], "leaf int, pages int")

    def paged(part: DataFrame, pages: DataFrame) -> DataFrame:
        return part.join(F.broadcast(pages), "leaf").withColumn("page", F.pmod(F.xxhash64("vec_id"), F.col("pages")).cast("int")).drop("pages", "away", "norm")

    def packed(part: DataFrame) -> DataFrame:
        dealt = part.select("leaf", "page", "vec_id", "label", "vector", "bounds").repartition("leaf", "page").sortWithinPartitions("leaf", "page", "vec_id")
        return dealt.mapInArrow(_packed, _PAGE)

    of_candidates, candidate_pages = leaves(routed, page_rows)
    is_anchor = F.col("vec_id") % every == 0
    of_anchors, anchor_pages = leaves(routed.filter(is_anchor), anchor_rows)
    candidates = written(packed(paged(routed, candidate_pages).withColumn("bounds", F.array().cast("array<long>"))), "candidate-pages")
    anchors = written(paged(routed.filter(is_anchor), anchor_pages), "anchors")

    def search(bounds: DataFrame, pairs: tuple[np.ndarray, np.ndarray], same: bool, k: int, name: str) -> DataFrame:
        """(anchor_id, place, other_id, score, rank): the best k in each window of (vec_id, bounds), from these pairs of leaves."""
        asked = packed(anchors.join(bounds, "vec_id"))
        to = pairs_of(spark, *pairs).join(candidate_pages.withColumnRenamed("leaf", "to"), "to")
        visits = asked.join(F.broadcast(to), "leaf").withColumn("at", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
        both = candidates.withColumn("kind", F.lit(0)).select("leaf", "page", "kind", "ids", "labels", "vectors", "bounds")
        both = both.union(visits.select("to", "at", F.lit(1), "ids", "labels", "vectors", "bounds"))
        dealt = both.repartition("leaf", "page").sortWithinPartitions("leaf", "page", "kind")
        found = dealt.mapInArrow(_scorer(width, same, k), "anchor_id long, place int, other_id long, score long")
        rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "other_id"))
        return written(found.withColumn("rank", rank).filter(F.col("rank") <= k), name)

    def needed(bounds: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of leaves that may hold scores inside the windows of (vec_id, bounds)."""
        each = anchors.join(bounds, "vec_id").select("leaf", F.posexplode("bounds").alias("at", "value"))
        low, high = np.full(1 << depth, float(_HIGH)), np.full(1 << depth, float(_LOW))
        for r in each.groupBy("leaf").agg(F.min(F.when(F.col("at") % 2 == 0, F.col("value"))).alias("low"), F.max(F.when(F.col("at") % 2 == 1, F.col("value"))).alias("high")).collect():  # at most MAX_LEAVES
            low[r.leaf], high[r.leaf] = r.low, r.high
        return surviving(tree, of_anchors, of_candidates, low, high)

    own = (np.arange(1 << depth), np.arange(1 << depth))
    everything = anchors.select("vec_id", F.array(F.lit(_LOW), F.lit(_HIGH)).alias("bounds"))
    fifth = search(everything, own, True, POSITIVES, "own-positives").filter(F.col("rank") == POSITIVES).select(F.col("anchor_id").alias("vec_id"), "score")
    floors = written(anchors.select("vec_id").join(fifth, "vec_id", "left").select("vec_id", F.array(F.coalesce("score", F.lit(_LOW)), F.lit(_HIGH)).alias("bounds")), "positive-floors")
    positives = search(floors, needed(floors), True, POSITIVES, "positives")

    window = positives.select("anchor_id", F.col("rank").alias("place"), F.col("score").alias("positive_score"), F.col("other_id").alias("positive_id"), *_window(F.col("score")))
    first = search(_bounds(window), own, False, NEGATIVES, "own-negatives").filter(F.col("rank") == NEGATIVES).select("anchor_id", "place", F.col("score").alias("tenth"))
    narrowed = written(window.join(first, ["anchor_id", "place"], "left").withColumn("low", F.greatest("low", "tenth")), "negative-windows")
    bounds = _bounds(narrowed)
    negatives = search(bounds, needed(bounds), False, NEGATIVES, "negatives")
    out = negatives.join(narrowed.select("anchor_id", "place", "positive_id", "positive_score"), ["anchor_id", "place"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def pairs_of(spark: SparkSession, anchors: np.ndarray, candidates: np.ndarray) -> DataFrame:
    """(leaf, to): at most MAX_LEAVES squared rows of two ints."""
    return spark.createDataFrame(pa.table({"leaf": pa.array(anchors, pa.int32()), "to": pa.array(candidates, pa.int32())}))


def _window(score: Column) -> tuple[Column, Column]:
    """Least and greatest whole score between LEAST and MOST hundredths of ``score``."""
    least, most = score * LEAST, score * MOST
    hundreds = lambda c, out: F.call_function("div", c, F.lit(100)).alias(out)
    return hundreds(least + F.pmod(-least, F.lit(100)), "low"), hundreds(most - F.pmod(most, F.lit(100)), "high")


def _bounds(windows: DataFrame) -> DataFrame:
    """(vec_id, bounds): the windows (low, high) of each anchor's positives in their order; missing ones hold no score."""
    held = F.map_from_entries(F.collect_list(F.struct("place", F.array("low", "high"))))
    of = lambda place: F.coalesce(F.element_at("m", place), F.array(F.lit(_HIGH), F.lit(_LOW)))
    return windows.groupBy(F.col("anchor_id").alias("vec_id")).agg(held.alias("m")).select("vec_id", F.concat(*[of(p + 1) for p in range(POSITIVES)]).alias("bounds"))
