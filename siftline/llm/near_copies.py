"""Groups of near copies: documents whose sets of word shingles have a Jaccard similarity of 0.8 or more.

Sketches choose what is compared and sets decide:

1. Texts of the same words are one body. Bodies meet in the bands of their SuperMinHash signatures, which miss a pair of
   similarity 0.8 with a chance of 1e-11.
2. In each band bucket a body takes one leader that is close by a 128-bit SimHash, so a bucket of any size gives a row
   a member. The pipeline's stage also links fingerprints within three bits by anchor covering (``simhash.links``).
3. These links are checked on the whole sets, and their components are formed.
4. Bodies of different components that meet are compared once more, each with each, by parities: a set's 1024 bits say
   whether an odd number of its shingles fall on each of 1024 places. Two sets differ in at least as many shingles as
   their parities differ in bits, and in at most a ninth of their sizes' sum at 0.8, so no pair is lost. What passes is
   held against up to 8192 parities and at last checked on the whole sets. Members of one component need no further
   links, so at first each body takes one partner of another component a bucket, and all pairs only of what is apart
   after that.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.shared_storage import written
from siftline.llm.simhash import _LOWER, connected, keep_rows, links
from siftline.llm.superminhash import band_keys, signatures
from siftline.llm.word_hashes import mix

#: Words of a shingle in the pipeline's stage, and in ``near_duplicates``.
SHINGLE_WORDS, PAIR_WORDS = 5, 2
#: Least Jaccard similarity, in tenths.
LEAST_TENTHS = 8
#: Of 128 bits: within which a document takes a leader.
LEADER_BITS = 28
#: Bits of a set's parities where documents meet, and at most.
PARITIES, MOST_PARITIES = 1024, 8192
#: Rows of one meeting that a task holds; larger meetings are split.
MEMBERS_PER_TASK = 4096
#: Elements whose signatures are drawn together.
_ELEMENTS = 1 << 17


def shingles(text: str | None, size: int = SHINGLE_WORDS) -> tuple[bytes, np.ndarray]:
    """(128-bit hash of the words, sorted distinct XXH64 of the word shingles); fewer words than ``size`` are one shingle."""
    words = (text or "").encode().translate(_LOWER).split()
    joined = b" ".join(words)
    body = xxhash.xxh3_128_digest(joined)
    if not words:
        return body, np.empty(0, np.uint64)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    size, digest = min(size, len(words)), xxhash.xxh64_intdigest
    return body, np.unique(np.array([digest(joined[a : b - 1], 42) for a, b in zip(ends, ends[size:], strict=False)], np.uint64))


def set_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """Two unsigned 64-bit halves of the SimHash of a set of shingle hashes."""
    ones = np.zeros(128, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        both = np.stack((part, mix(part)), 1)
        ones += np.unpackbits(both.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)


def parities(hashes: np.ndarray) -> bytes:
    """For each place that a shingle hash can fall on, whether an odd number of the set does; larger sets have more places."""
    places = PARITIES
    while places < min(2 * len(hashes), MOST_PARITIES):
        places *= 2
    return np.packbits(np.bincount((mix(hashes) % np.uint64(places)).astype(np.int64), minlength=places) & 1).tobytes()


def _folded(odd: bytes, size: int) -> np.ndarray:
    """Parities of fewer places, as words."""
    return np.bitwise_xor.reduce(np.frombuffer(odd, np.uint64).reshape(-1, size // 64), axis=0)


def _allowed(n: np.ndarray, m: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes that differ in so many shingles at least can be near copies."""
    return (10 + LEAST_TENTHS) * differ <= (10 - LEAST_TENTHS) * (n + m)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([*arrays, np.empty(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(list(accumulate(map(len, arrays), initial=0)), pa.int32()), pa.array(flat))


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(x.as_py(), size) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.binary()), _lists([s for _, s in found])], names=["key", "all"])

    return run


def _bands(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The band keys of each set; an empty set has none."""
    out: list[np.ndarray] = []
    for at in _runs([len(s) for s in sets]):
        sizes = np.array([len(s) for s in sets[at]], np.int64)
        keys = band_keys(signatures(np.concatenate(sets[at]), sizes))
        out += [k if n else k[:0] for k, n in zip(keys, sizes.tolist(), strict=True)]
    return out


def _runs(sizes: list[int]) -> Iterator[slice]:
    """Slices of about ``_ELEMENTS`` elements, or of one larger set."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > _ELEMENTS:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def _prints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                found = [shingles(x.as_py(), size) for x in rows.column(1)]
                sets = [s for _, s in found]
                halves = np.array([set_fingerprint(s) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
                columns = [rows.column(0), rows.column(2), pa.array([b for b, _ in found], pa.binary()), pa.array([len(s) for s in sets], pa.int32()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array([parities(s) for s in sets], pa.binary()), _lists(_bands(sets))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "text_hash", "key", "n", "fp", "fp2", "odd", "bands"])

    return run


def _rows_of_bits(column: pa.Array) -> np.ndarray:
    return np.stack([_folded(x, PARITIES) for x in column.to_pylist()]) if len(column) else np.empty((0, PARITIES // 64), np.uint64)


def _meetings(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(columns, starts of groups with an end) of whole groups; rows come sorted by the first ``keys`` columns."""
    held: list[np.ndarray] = []
    for batch in batches:
        columns = [_rows_of_bits(c) if pa.types.is_binary(c.type) else c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = [np.concatenate(x) for x in zip(held, columns, strict=True)] if held else columns
        new = np.zeros(max(len(held[0]) - 1, 0), bool)
        for c in held[:keys]:
            new |= c[1:] != c[:-1]
        starts = np.flatnonzero(new) + 1
        if len(starts):
            yield [c[: starts[-1]] for c in held], np.concatenate(([0], starts))
            held = [c[starts[-1] :] for c in held]
    if held and len(held[0]):
        yield held, np.array([0, len(held[0])])


def _bits(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    return np.bitwise_count((a[0] ^ b[0]).view(np.uint64)) + np.bitwise_count((a[1] ^ b[1]).view(np.uint64))


def _alike(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can be near copies."""
    return 10 * np.minimum(n, m) >= LEAST_TENTHS * np.maximum(n, m)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (s, part, body, n, fp, fp2) to a pair per member with the first that is close to it; those lead who have none."""
    for (_, _, body, n, *fp), starts in _meetings(batches, 2):
        sizes = np.diff(starts)
        for m in np.unique(sizes[(sizes > 1) & (sizes <= 8)]):
            at = starts[:-1][sizes == m][:, None] + np.arange(m)
            x, y = [c[at][:, :, None] for c in (n, *fp)], [c[at][:, None, :] for c in (n, *fp)]
            close = _alike(x[0], y[0]) & (_bits(x[1:], y[1:]) <= LEADER_BITS) & np.tri(m, k=-1, dtype=bool)
            g, i = np.nonzero(close.any(2))
            yield _pairs(body[at[g, i]], body[at[g, close[g, i].argmax(1)]])
        for s, e in zip(starts[:-1][sizes > 8], starts[1:][sizes > 8], strict=True):
            left = np.arange(s, e)
            while len(left) > 1:
                lead, rest = left[0], left[1:]
                close = _alike(n[rest], n[lead]) & (_bits([c[rest] for c in fp], [c[lead] for c in fp]) <= LEADER_BITS)
                if close.any():
                    yield _pairs(body[rest[close]], np.repeat(body[lead], close.sum()))
                left = rest[~close]


def _within_bound(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Whether sets of (label, n, parities) are of two components and their parities allow a similarity of 0.8."""
    out = (x[0] != y[0]) & _alike(x[1], y[1])
    differ = np.zeros(out.shape, np.int32)
    for word in range(PARITIES // 64):
        differ += np.bitwise_count(x[2][..., word] ^ y[2][..., word])
    return out & _allowed(x[1], y[1], differ)


def _apart(first: bool):
    """Rows (s, part, role, body, label, n, odd), role 0 home, 1 visitor, 2 both, to all pairs that the bound allows, or with
    ``first`` to at most one for each visitor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, role, body, *rest), starts in _meetings(batches, 2):
            sizes, label = np.diff(starts), rest[0]
            mixed = np.zeros(len(body), bool)
            mixed[1:] = label[1:] != label[:-1]
            mixed[starts[:-1]] = False
            mixed = np.add.reduceat(mixed, starts[:-1], dtype=np.int64) > 0
            small = mixed & (sizes <= 8) & (role[starts[:-1]] == 2)
            for m in np.unique(sizes[small]):
                groups = starts[:-1][small & (sizes == m)]
                for g0 in range(0, len(groups), 4096):
                    at = groups[g0 : g0 + 4096][:, None] + np.arange(m)
                    near = _within_bound([c[at][:, :, None] for c in rest], [c[at][:, None, :] for c in rest]) & np.tri(m, k=-1, dtype=bool)
                    g, i, j = np.nonzero(_firsts(near) if first else near)
                    yield _pairs(body[at[g, i]], body[at[g, j]])
            for s, e in zip(starts[:-1][mixed & ~small], starts[1:][mixed & ~small], strict=True):
                visitors, homes = s + np.flatnonzero(role[s:e] > 0), s + np.flatnonzero(role[s:e] != 1)
                for at in range(0, len(visitors), 256):
                    v = visitors[at : at + 256]
                    near = _within_bound([c[v][:, None] for c in rest], [c[homes][None] for c in rest])
                    i, j = np.nonzero(_firsts(near) if first else near)
                    yield _pairs(body[v[i]], body[homes[j]])

    return run


def _firsts(near: np.ndarray) -> np.ndarray:
    """The first true value along the last axis alone."""
    return near & (np.cumsum(near, axis=-1) == 1)


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, n, odd, m, odd2) to the pairs that all their parities allow."""
    for batch in batches:
        a, b, n, odd, m, odd2 = (batch.column(i) for i in range(6))
        differ = np.zeros(len(a), np.int64)
        for i, (x, y) in enumerate(zip(odd.to_pylist(), odd2.to_pylist(), strict=True)):
            size = 8 * min(len(x), len(y))
            differ[i] = np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum()
        use = pa.array(_allowed(n.to_numpy(), m.to_numpy(), differ))
        yield pa.RecordBatch.from_arrays([a.filter(use), b.filter(use)], names=["a", "b"])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"))


def bodies_of(texts: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(prints, bodies), written: a row for each of ``texts`` with the key of its words, and a numbered row for each key."""
    kind = texts.schema["id"].dataType.simpleString()
    prints = written(texts.mapInArrow(_prints(size), f"id {kind}, text_hash long, key binary, n int, fp long, fp2 long, odd binary, bands array<long>"), "prints")
    row = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("text_hash").alias("h"))
    one = prints.groupBy("key").agg(F.min(row).alias("k"), *[F.first(c).alias(c) for c in ("n", "fp", "fp2", "odd", "bands")])
    return prints, written(one.withColumn("body", F.monotonically_increasing_id()), "bodies")


def _near(pairs: DataFrame, bodies: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets have the similarity; only texts of plausible pairs are read again."""
    of = lambda end, n, odd: bodies.select(F.col("body").alias(end), F.col("n").alias(n), F.col("odd").alias(odd))
    sketched = pairs.join(of("a", "n", "odd"), "a").join(of("b", "m", "odd2"), "b").select("a", "b", "n", "odd", "m", "odd2")
    pairs = written(sketched.mapInArrow(_plausible, "a long, b long"), "plausible-pairs")
    asked = pairs.select(F.col("a").alias("body")).union(pairs.select("b")).distinct().join(bodies.select("body", "key", "k"), "body")
    asked = written(asked.select("body", F.col("key").alias("asked_key"), F.col("k.id").alias("asked_id"), F.col("k.h").alias("asked_hash")), "asked")
    there = texts.join(asked, texts["id"].eqNullSafe(asked["asked_id"]) & (texts["text_hash"] == asked["asked_hash"]), "left_semi")
    sets = there.select("t").mapInArrow(_sets(size), "key binary, all array<long>").groupBy("key").agg(F.first("all").alias("all"))
    sets = written(sets.join(asked, sets["key"] == asked["asked_key"]).select("body", "all"), "shingle-sets")
    both = pairs.join(sets.select(F.col("body").alias("a"), F.col("all").alias("x")), "a").join(sets.select(F.col("body").alias("b"), F.col("all").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return written(both.filter(10 * shared >= LEAST_TENTHS * (F.size("x") + F.size("y") - shared)).select("a", "b"), "near")


def _anchored(bodies: DataFrame) -> DataFrame:
    """(a, b): the forest of fingerprints within three bits, and all bodies of one fingerprint with the first of them."""
    leads = written(bodies.groupBy("fp").agg(F.min("body").alias("lead")), "leads")
    forest = links(leads)
    for end in ("a", "b"):
        forest = forest.join(leads.select(F.col("fp").alias(end), F.col("lead").alias(f"lead_{end}")), end)
    same = bodies.select("fp", "body").join(leads, "fp").filter("body <> lead").select(F.least("body", "lead").alias("a"), F.greatest("body", "lead").alias("b"))
    return forest.select(F.least("lead_a", "lead_b").alias("a"), F.greatest("lead_a", "lead_b").alias("b")).union(same)


def labelled(bodies: DataFrame, texts: DataFrame, size: int, anchored: bool = False, members_per_task: int = MEMBERS_PER_TASK) -> DataFrame:
    """(node, label) of every body that is linked to another: the smallest body of its component."""
    # only bands in which several bodies meet
    held = bodies.select(F.explode("bands").alias("s"), "body")
    sizes = held.groupBy("s").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = written(held.join(sizes, "s").join(bodies.select("body", "n", "fp", "fp2"), "body").select("s", "members", "body", "n", "fp", "fp2"), "meetings")
    part = F.pmod(F.xxhash64("body"), F.ceil(F.col("members") / members_per_task).cast("int")).cast("int").alias("part")
    dealt = met.select("s", part, "body", "n", "fp", "fp2").repartition("s", "part").sortWithinPartitions("s", "part", "body")
    pairs = dealt.mapInArrow(_led, "a long, b long")
    pairs = written((pairs.union(_anchored(bodies)) if anchored else pairs).distinct(), "candidates")
    edges = _near(pairs, bodies, texts, size)
    labels = written(connected(edges), "labels")

    # what meets and is still apart: one partner each, then all
    met, checked = met.select("s", "members", "body"), pairs
    for first in (True, False):
        now = met.join(labels.withColumnRenamed("node", "body"), "body", "left").withColumn("label", F.coalesce("label", "body"))
        several = now.groupBy("s").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("s")
        now = written(now.join(several, "s", "left_semi"), "still-apart")
        met = now.select("s", "members", "body")
        rest = ["body", "label", "n", "odd"]
        now = now.join(bodies.select("body", "n", "odd"), "body")
        whole = now.filter(F.col("members") <= members_per_task).select("s", F.lit(0).alias("part"), F.lit(2).alias("role"), *rest)
        dealt = whole.union(_cells(now.filter(F.col("members") > members_per_task), members_per_task, rest)).repartition("s", "part").sortWithinPartitions("s", "part", "role")
        further = written(dealt.mapInArrow(_apart(first), "a long, b long").distinct(), "further-candidates")
        further = further.join(checked, ["a", "b"], "left_anti")
        checked = checked.union(further)
        found = _near(further, bodies, texts, size)
        if not found.isEmpty():
            edges = edges.union(found)
            labels = written(connected(edges), "labels")
    return labels


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", members_per_task: int = MEMBERS_PER_TASK) -> DataFrame:
    """The rows of ``docs`` with one row of each group of near copies: the smallest (id, hash of the text).

    Groups are the components of all pairs of similarity 0.8 or more over five-word shingles. Null, empty and wordless
    texts are one group. The columns and their order stay, whatever their names; rows without an id count after those
    with one. Of rows that share id and text the least by its other columns stays. Texts are taken whole; an empty table
    stays empty.
    """
    texts = _texts(docs, id_col, text_col)
    bodies = bodies_of(texts, SHINGLE_WORDS)[1]
    labels = labelled(bodies, texts, SHINGLE_WORDS, True, members_per_task)
    of = bodies.select("body", "k").join(labels, bodies["body"] == labels["node"], "left")
    kept = of.groupBy(F.coalesce("label", "body").alias("component")).agg(F.min("k").alias("k"))
    return keep_rows(docs, kept.select(F.col("k.id").alias("_id"), F.col("k.h").alias("_h")), id_col, text_col)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = PAIR_WORDS, members_per_task: int = MEMBERS_PER_TASK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    A text's set are its distinct word shingles of ``size`` words, A-Z lowered; fewer words are one shingle. Documents of
    similarity 0.8 or more are linked, checked on whole sets of 64-bit shingle hashes; texts of the same words are told
    from others by 128 bits. A text without words, or null, is linked with nothing. Null ids are grouped like others, are
    never the smallest of a group that has an id, and are kept only where a group has none. Repeated rows are rows of
    one group. An empty table gives no rows; other columns are not read, whatever their names.
    """
    texts = _texts(docs, id_col, text_col)
    prints, bodies = bodies_of(texts, size)
    labels = labelled(bodies, texts, size, members_per_task=members_per_task)
    of = bodies.filter("n > 0").select("body", F.col("k.id").alias("id")).join(labels, F.col("body") == F.col("node"), "left").select("body", "id", F.coalesce("label", "body").alias("label"))
    least = of.groupBy("label").agg(F.min("id").alias("least"))
    place = of.select("body", "label").join(least, "label").join(bodies.select("body", F.col("key").alias("k")), "body").select("k", "least")
    rows = prints.select("id", "key", "n")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("least"))
    out = rows.join(written(place, "places"), rows["key"] == F.col("k"), "left").select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _cells(crowded: DataFrame, members_per_task: int, rest: list[str]) -> DataFrame:
    """Large meetings as cells of homes and visitors. Homes are the members outside the meeting's largest component: a
    pair of two components has one of these at least."""
    of = crowded.groupBy("s", "label").agg(F.count(F.lit(1)).alias("c"))
    top = of.groupBy("s").agg(F.max_by("label", F.struct("c", "label")).alias("top"), (F.sum("c") - F.max("c")).alias("homes"), F.sum("c").alias("all"))
    rows = crowded.join(top.filter("homes > 0"), "s")
    n_homes, n_all = (F.ceil(F.col(c) / members_per_task).cast("int") for c in ("homes", "all"))
    own = lambda n: F.pmod(F.xxhash64("body"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    home = rows.filter("label <> top").select("s", (own(n_homes) * n_all).alias("first"), every(n_all).alias("step"), F.lit(0).alias("role"), *rest)
    visitor = rows.select("s", own(n_all).alias("first"), n_all.alias("cells"), every(n_homes).alias("step"), F.lit(1).alias("role"), *rest)
    visitor = visitor.select("s", "first", (F.col("step") * F.col("cells")).alias("step"), "role", *rest)
    return home.union(visitor).select("s", (F.col("first") + F.col("step")).alias("part"), "role", *rest)
