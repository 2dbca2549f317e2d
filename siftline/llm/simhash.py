"""SimHash near-duplicate groups by anchor-point covering.

Fingerprints differing in at most three bits differ in at most one bit of one 32-bit half. Per half, the anchors are
the codewords of the perfect [31, 26] Hamming code (covering radius 1) over its low 31 bits. A fingerprint is at home
at its one anchor within the covering radius, and is replicated to every anchor within covering radius plus threshold,
2: one if it is a codeword, 16 otherwise. Two halves within one bit of each other then meet at the home of either, so
no pair is lost, and all 64 bits are compared per anchor. Equal fingerprints are merged first; an anchor emits a
spanning forest of its links, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.shared_storage import checkpointed, written

SHINGLE_WORDS = 3
MAX_BITS = 3
#: Homes of an anchor that one task holds; an anchor with more is split, its visitors going to every split.
HOMES_PER_TASK = 4096
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def text_fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit SimHash: majority of the bits of XXH64 (seed 42) over word shingles, repeats included."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(words) - size + 1
    for at in range(0, n, 1 << 15):
        to = min(at + (1 << 15), n)
        hashes = np.array([digest(joined[a : b - 1], 42) for a, b in zip(ends[at:to], ends[at + size : to + size], strict=True)], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(``id_col``, fp long, text_hash long): a row per row of ``docs``; a null text counts as empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([text_fingerprint(x.as_py(), shingle) for x in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), batch.column(2)], names=["id", "fp", "text_hash"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"))
    return texts.mapInArrow(run, f"id {kind}, fp long, text_hash long")


def _anchors(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, anchor, is it the row's home) of unsigned fingerprints, in pieces.

    The syndrome is the exclusive or of the 1-based positions of the set bits; flipping positions i and j (0: none)
    gives a codeword exactly if i ^ j is the syndrome.
    """
    rows = np.arange(len(fps))
    for half in range(2):
        v = ((fps >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)).astype(np.int64)
        syndrome = np.zeros(len(v), np.int64)
        for bit in range(31):
            syndrome ^= np.where(v >> bit & 1, bit + 1, 0)
        bits = np.concatenate(([0], np.int64(1) << np.arange(31)))
        for i in range(32):
            j = syndrome ^ i
            use = np.flatnonzero((i < j) & (syndrome > 0) | (i == 0) & (j == 0))
            yield rows[use], (v ^ bits[i] ^ bits[j])[use] | half << 31, np.full(len(use), i == 0)


def _replicated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for row, anchor, home in _anchors(fps.view(np.uint64)):
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fps[row]), pa.array(home)], names=["anchor", "fp", "home"])


def _near(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)) <= max_bits


class _Anchor:
    """The homes of one anchor and the forest their links have built so far; visitors stream past."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.homes: np.ndarray | None = None

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def visit(self, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Links of visitors to their first near home; a visitor near several homes joins these in the forest."""
        if self.homes is None:
            self.homes = np.concatenate(self.parts) if self.parts else np.empty(0, np.int64)
            self.up = list(range(len(self.homes)))
        a, b = [], []
        step = max(1, (1 << 20) // max(1, len(self.homes)))
        for at in range(0, len(fps) if len(self.homes) else 0, step):
            part = fps[at : at + step]
            v, h = np.nonzero(_near(part[:, None], self.homes[None, :], max_bits))
            firsts = np.concatenate(([True], v[1:] != v[:-1])) if len(v) else np.empty(0, bool)
            a.append(part[v[firsts]])
            b.append(self.homes[h[firsts]])
            lead = h[firsts][np.cumsum(firsts) - 1] if len(v) else h
            for i, j in np.unique(np.stack((lead, h), 1)[lead != h], axis=0).tolist():
                x, y = self.root(i), self.root(j)
                if x != y:
                    self.up[y] = x
        return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, np.int64), np.empty(0, np.int64))

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        if self.homes is None:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return self.homes, self.homes[[self.root(i) for i in range(len(self.homes))]]


def _linker(max_bits: int):
    """Rows sorted by (key columns, home first) to links (a, b); groups may run over any number of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, _Anchor()

        def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            use = a != b
            return pa.RecordBatch.from_arrays([pa.array(a[use]), pa.array(b[use])], names=["a", "b"])

        for batch in batches:
            anchor, fp, home, split = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if not len(anchor):
                continue
            cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (split[1:] != split[:-1])) + 1
            starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(anchor)]))
            size, homes = ends - starts, np.add.reduceat(home.astype(np.int64), starts)
            small = (homes > 0) & (size > 1) & (homes * size <= 64)
            small[[0, -1]] = False  # may go on in another batch
            for g in (g for h in range(1, 9) for g in [np.flatnonzero(small & (homes == h))] if len(g)):
                n = homes[g[0]]
                for m in np.unique(size[g]):
                    s = starts[g[size[g] == m]]
                    x, y = fp[s[:, None] + np.arange(n)][:, :, None], fp[s[:, None] + np.arange(m)][:, None, :]
                    at = np.nonzero(_near(x, y, max_bits))
                    yield out(x[at[0], at[1], 0], y[at[0], 0, at[2]])
            large = (homes * size > 64) | (homes > 8)
            large[[0, -1]] = True
            for g in np.flatnonzero(large):
                s, e = starts[g], ends[g]
                if (anchor[s], split[s]) != key:
                    yield out(*state.forest())
                    key, state = (anchor[s], split[s]), _Anchor()
                first = s + int(home[s:e].sum())
                if first > s:
                    state.parts.append(fp[s:first])
                if state.parts:  # without a home there is nothing to meet; homes sort first and visit as well
                    if first < e:
                        yield out(*state.visit(fp[first:e], max_bits))
        yield out(*state.forest())

    return run


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, homes_per_task: int = HOMES_PER_TASK) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints (distinct ``fp`` long) within ``max_bits`` <= 3 bits.

    Not every pair is a row, but every near pair is joined by a path of rows, each of them a pair within the bound or
    two homes near one visitor.
    """
    if max_bits > MAX_BITS:
        raise ValueError("the halves of the covering allow 3 bits at most")
    rows = fingerprints.select("fp").mapInArrow(_replicated, "anchor long, fp long, home boolean")
    crowded = written(rows.filter("home").groupBy("anchor").count().filter(F.col("count") > homes_per_task), "crowded-anchors")
    if crowded.isEmpty():
        rows = rows.withColumn("split", F.lit(0))
    else:
        splits = crowded.select("anchor", F.ceil(F.col("count") / homes_per_task).cast("int").alias("n"))
        rows = rows.join(splits, "anchor", "left").withColumn("n", F.coalesce("n", F.lit(1)))
        own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
        visits = rows.withColumn("split", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        rows = visits.withColumn("home", F.col("home") & (F.col("split") == own)).select("anchor", "fp", "home", "split")
    # a home is also a visitor of its anchor, so that homes meet one another
    rows = rows.select("anchor", "fp", "split", F.explode(F.when(F.col("home"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))).alias("home"))
    dealt = rows.select("anchor", "fp", "home", "split").repartition("anchor", "split").sortWithinPartitions("anchor", "split", F.desc("home"))
    return dealt.mapInArrow(_linker(max_bits), "a long, b long").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, label): for every node of ``edges`` (a, b) the smallest node that it can reach.

    Labels spread along edges and then jump to their label's label, so the number of rounds follows the logarithm of
    a component's width. Each round is a join, a minimum with map-side combining, and a reliable checkpoint.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        spread = labels.join(seen, "node").select("node", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        spread = checkpointed(spread)
        jump = spread.select(F.col("node").alias("label"), F.col("label").alias("next"))
        # dealt by node again, so that a large component's rows don't stay where its label put them
        new = checkpointed(spread.join(jump, "label").select("node", F.col("next").alias("label"), F.col("old")).repartition("node"))
        labels = new.select("node", "label")
        if new.filter("label <> old").isEmpty():
            return labels


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, text_hash, component, label): component is the smallest id whose text is reachable over links.

    Null and empty texts have fingerprint zero and link like any other. Null ids are grouped with the others and are
    never the smallest (null only where a whole component has no id); ``label``, a fingerprint of the component, tells
    such components apart. Repeated rows stay rows. An empty table gives an empty table; other columns are not read.
    """
    prints = written(with_fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    labels = written(connected(links(distinct)), "labels")
    member = written(labels.join(distinct, labels["node"] == distinct["fp"]).select("fp", "label", "least"), "members")
    smallest = written(member.groupBy("label").agg(F.min("least").alias("component")), "smallest")
    linked = member.join(smallest, "label").select(F.col("fp").alias("linked_fp"), "component", "label")
    of = distinct.join(linked, distinct["fp"] == linked["linked_fp"], "left")
    of = written(of.select(F.col("fp").alias("k"), F.coalesce("component", "least").alias("component"), F.coalesce("label", "fp").alias("label")), "components")
    return prints.join(of, prints["fp"] == of["k"]).select("id", "fp", "text_hash", "component", "label")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint of 16 hex digits, component_id) for every row of ``docs``; see ``groups``."""
    g = groups(docs, id_col, text_col)
    return g.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each group: the smallest (id, hash of the text).

    The columns and their order stay, whatever their names; rows without an id count after those with one, and a group
    without any id keeps one row as well. Of rows that share id and text the least by its other columns stays.
    """
    g = groups(docs, id_col, text_col)
    order = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("id"), F.col("text_hash").alias("h"))
    kept = g.groupBy("label").agg(F.min(order).alias("k"))
    return keep_rows(docs, kept.select(F.col("k.id").alias("_id"), F.col("k.h").alias("_h")), id_col, text_col)


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row of ``docs`` for each row of ``kept``: (_id, _h), an id and the hash of its text.

    Of rows that share both the least by its columns stays; maps and variants have no order, there any of them does.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    keyed = plain.withColumn("_h", F.xxhash64(F.coalesce(F.col(place[text_col]), F.lit("")))).withColumn("_id", F.col(place[id_col]))
    hit = keyed.join(kept, keyed["_id"].eqNullSafe(kept["_id"]) & (keyed["_h"] == kept["_h"]), "left_semi")
    ordered = not any(t in f.dataType.simpleString() for f in docs.schema for t in ("map<", "variant"))
    one = F.min(F.struct(*plain.columns)) if ordered else F.first(F.struct(*plain.columns))
    return hit.groupBy("_id", "_h").agg(one.alias("r")).select("r.*").toDF(*docs.columns)
