"""Stupid-backoff scores of documents against all others, from count tables partitioned by hash.

A document's words, with a boundary before and after, make word pairs. S(b | a) is count(a b) / count(a) if other
documents hold the pair, else 0.4 * count(b) / count(all): pair counts leave the document's own out, word counts don't.
The score is the mean of log10 S over its words and its end.

Pairs are shuffled once, packed in arrays per bucket, to where all their occurrences meet; there they are counted and
scored by windows, and partial sums return per document. Words among the most frequent travel as 16-bit ranks, and
their counts reach every task (a bounded table). A pair with one other word lies with all pairs of that word, so that
word's count is known there too; a pair of two other words lies with both. Pairs of the very most frequent words, which
would make hot keys, are counted by map-side combining into a bounded table and scored where they are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.shared_storage import small_batches, written
from siftline.llm.word_hashes import mix, pair, word_batches

ALPHA = 0.4
#: Words with a rank; rank 0 is the boundary.
RANKED = 1 << 16
#: Ranks whose pairs are counted apart: at most HOT * HOT counts.
HOT = 64
#: About how many rows, spread over the whole table by hash, the words whose pairs are counted apart are guessed from.
GUESS_ROWS = 2000
BATCH = "4m"
CHUNK = 1 << 20
_PAIRS_A_ROW = 1 << 16
_PACKED = "bucket int, side int, key array<long>, own array<int>, a array<short>, b array<short>, al array<long>, bl array<long>, given array<double>"
_NONE = {"own": pa.int32(), "a": pa.int16(), "b": pa.int16(), "al": pa.int64(), "bl": pa.int64(), "given": pa.float64()}


def _counts(frequent: np.ndarray):
    """(word, n) of each word, where word 0 counts documents that have words, and (cell, n) of the pairs of hot words.

    A task merges what it has counted so far whenever that grows long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = np.arange(1, len(frequent) + 1)
        order = np.argsort(frequent)
        found, counts, docs, cells = np.empty(0, np.uint64), np.empty(0, np.int64), 0, np.zeros(HOT * HOT, np.int64)
        for batch in batches:
            for _, doc, a, b in _doc_pairs(batch.column(0), np.empty(0, np.uint64), ranks):
                docs += int((b == 0).sum())
                words, n = np.unique(b[b != 0].view(np.uint64), return_counts=True)
                found, counts = np.concatenate((found, words)), np.concatenate((counts, n))
                if len(found) > 1 << 20:
                    found, counts = _summed(found, counts)
                    if len(found) > 1 << 19:
                        yield _count_rows(found.view(np.int64), counts, np.zeros(0, np.int64), np.zeros(0, np.int64))
                        found, counts = found[:0], counts[:0]
                x, y = (_known(c.view(np.uint64), frequent[order], ranks[order]) for c in (a, b))
                hot = (x >= 0) & (y >= 0)
                cells += np.bincount(x[hot] * HOT + y[hot], minlength=HOT * HOT)
        found, counts = _summed(found, counts)
        seen = np.flatnonzero(cells)
        yield _count_rows(np.append(found.view(np.int64), 0), np.append(counts, docs), seen, cells[seen])

    return run


def _count_rows(word: np.ndarray, n: np.ndarray, cell: np.ndarray, n_cell: np.ndarray) -> pa.RecordBatch:
    kind = np.repeat(np.array([0, 1], np.int32), [len(word), len(cell)])
    return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate((word, cell))), pa.array(np.concatenate((n, n_cell)))], names=["kind", "word", "n"])


def _summed(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words, at = np.unique(words, return_inverse=True)
    return words, np.bincount(at, weights=counts, minlength=len(words)).astype(np.int64)


def _known(code: np.ndarray, words: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The rank of each word that has one, as it is otherwise; 0 is the boundary."""
    if not len(words):
        return code.view(np.int64)
    at = np.minimum(np.searchsorted(words, code), len(words) - 1)
    return np.where(words[at] == code, ranks[at], code.view(np.int64))


def _first_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, w in word_batches(batch.column(0)):
            words, n = np.unique(_rare(w.hash), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])


def _rare(h: np.ndarray) -> np.ndarray:
    """63 bits of a word's hash; the top bit tells hashes from ranks."""
    return h | np.uint64(1 << 63)


def _doc_pairs(texts: pa.Array, words: np.ndarray, ranks: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, document, context, target) of every word pair, whole documents at a time; words are ranks or negative hashes."""
    for first, _, w in word_batches(texts, chunk_bytes=CHUNK):
        code = _known(_rare(w.hash), words, ranks)
        if not len(code):
            continue
        starts = np.concatenate(([True], w.doc[1:] != w.doc[:-1]))
        # a document of n words has n + 1 pairs: its words as targets and the end
        slot = np.arange(len(code)) + np.cumsum(starts) - 1
        n = len(code) + int(starts.sum())
        doc, target, context = np.empty(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        target[slot], context[slot + 1] = code, code
        doc[slot] = w.doc
        doc[slot + 1] = w.doc
        yield first, doc, context, target


def _pack(shipped, hot_table, buckets: int):
    """Rows of ``_PACKED``: per chunk of documents, bucket and side the pairs of its documents with their own counts."""

    def rows(side: int, group: np.ndarray, key: np.ndarray, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(key):
            return
        bucket = (mix(group.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        edges = np.unique(np.concatenate([edges, *[np.arange(s, e, _PAIRS_A_ROW) for s, e in zip(edges[:-1], edges[1:], strict=True)]]))
        n = len(edges) - 1
        lists = lambda x: pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(x[order]))
        none = lambda t: pa.ListArray.from_arrays(pa.array(np.zeros(n + 1), pa.int32()), pa.array([], t))
        out = [pa.array(bucket[edges[:-1]].astype(np.int32)), pa.array(np.full(n, side, np.int32)), lists(key)]
        out += [lists(columns[c]) if c in columns else none(t) for c, t in _NONE.items()]
        yield pa.RecordBatch.from_arrays(out, names=["bucket", "side", "key", *_NONE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts, total, n_hot = hot_table.value
        for batch in batches:
            keys = batch.column(1).to_numpy()
            for first, doc, a, b in _doc_pairs(batch.column(0), *shipped.value):
                whole = mix(pair(a.view(np.uint64), b.view(np.uint64)) + doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                _, at, own = np.unique(whole, return_index=True, return_counts=True)
                order = np.argsort(at)
                at, own = at[order], own[order].astype(np.int32)
                n_doc = np.bincount(doc)
                doc, a, b = doc[at], a[at], b[at]
                key = keys[first + doc]
                hot = (a >= 0) & (a < n_hot) & (b >= 0) & (b < n_hot)
                others = table[np.where(hot, a * HOT + b, 0)] - own
                with np.errstate(divide="ignore", invalid="ignore"):
                    s = np.where(others > 0, np.log10(others) - np.log10(counts[np.where(hot, a, 0)]), np.log10(ALPHA) + np.log10(counts[np.where(hot, b, 0)]) - np.log10(total))
                given = np.bincount(doc[hot], weights=(own * s)[hot], minlength=len(n_doc))
                backed = np.bincount(doc[hot], weights=(own * (others <= 0))[hot], minlength=len(n_doc))
                present = np.flatnonzero(n_doc)
                there = keys[first + present]
                yield from rows(3, there, there, own=n_doc[present].astype(np.int32), bl=backed[present].astype(np.int64), given=given[present].astype(np.float64))
                ra, rb = a >= 0, b >= 0
                use = ra & rb & ~hot
                short = lambda x: (x - RANKED // 2).astype(np.int16)
                yield from rows(0, pair(a[use].view(np.uint64), b[use].view(np.uint64)), key[use], own=own[use], a=short(a[use]), b=short(b[use]))
                yield from rows(1, b[~rb], key[~rb], own=own[~rb], al=a[~rb], bl=b[~rb])
                yield from rows(2, a[~ra], key[~ra], own=own[~ra], al=a[~ra], bl=b[~ra])

    return run


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_predictions, n_backoff, mean_log10) of every row of ``docs``.

    Words are runs of other than ASCII white space, A-Z lower-cased. A null or wordless text has 0 predictions and a
    null mean. Repeated rows are documents of their own: each has the other's pairs to draw on. Other columns are not
    read; an empty table stays empty.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("key"), F.col(id_col).alias("id"))
    # which words count as hot is guessed from rows of all parts of the table; their counts are of all rows
    every = max(1, docs.count() // GUESS_ROWS)
    spread = rows.filter(F.pmod("key", F.lit(every)) == 0)
    guess = spread.select("text").mapInArrow(_first_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(HOT - 1).collect()
    frequent = np.array([r.word for r in guess], np.int64)
    with small_batches(spark, BATCH):
        counted = written(rows.select("text").mapInArrow(_counts(frequent.view(np.uint64)), "kind int, word long, n long").groupBy("kind", "word").agg(F.sum("n").alias("n")), "word-counts")
    words, hot = counted.filter("kind = 0").drop("kind"), np.zeros(HOT * HOT, np.int64)
    for r in counted.filter("kind = 1").collect():  # HOT * HOT rows at most
        hot[r.word] = r.n
    n_docs = words.filter("word = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]  # words and ends of documents
    ranked = words.filter("word <> 0").orderBy(~F.col("word").isin(frequent.tolist()), F.desc("n"), "word").limit(RANKED - 1).toArrow()  # bounded
    top, n_top = ranked["word"].to_numpy(), ranked["n"].to_numpy()
    order = {w: i for i, w in enumerate(frequent.tolist())}
    place = np.array(sorted(range(len(top)), key=lambda i: order.get(top[i], HOT + i)), np.int64)
    top, n_top = top[place].view(np.uint64), n_top[place]
    by_hash = np.argsort(top)
    ranks = sc.broadcast((top[by_hash], by_hash + 1))
    counts = np.array([n_docs, *n_top], np.float64)
    known = sc.broadcast((hot, np.pad(counts[:HOT], (0, max(0, HOT - len(counts)))), float(total), len(frequent) + 1))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = rows.select("text", "key").mapInArrow(_pack(ranks, known, parts), _PACKED).repartitionById(parts, "bucket")
    each = packed.select("bucket", "side", F.explode(F.arrays_zip("key", "own", "a", "b", "al", "bl", "given")).alias("x")).select("bucket", "side", "x.*")
    wide = lambda code, word: F.coalesce(F.col(code).cast("long") + F.lit(RANKED // 2), F.col(word))
    each = each.select("bucket", "side", "key", "own", wide("a", "al").alias("a"), wide("b", "bl").alias("b"), "given")
    each = each.withColumn("g", F.when(F.col("side") == 0, F.xxhash64("a", "b")).when(F.col("side") == 1, F.col("b")).when(F.col("side") == 2, F.col("a")).otherwise(F.col("key")))
    # sorted by the group first, whose leading bits settle nearly all comparisons; buckets only say where rows are
    group = ["g", "bucket", "side"]
    met = each.withColumn("pairs", F.sum("own").over(Window.partitionBy(*group, "a", "b"))).withColumn("meeting", F.sum("own").over(Window.partitionBy(*group)))
    with np.errstate(divide="ignore"):
        logs = pa.table({"rank": np.arange(len(counts)), "log": np.log10(counts)})
    frequent = F.broadcast(spark.createDataFrame(logs))  # RANKED rows at most
    met = met.join(frequent.select(F.col("rank").alias("a"), F.col("log").alias("log_a")), "a", "left").join(frequent.select(F.col("rank").alias("b"), F.col("log").alias("log_b")), "b", "left")
    others = F.col("pairs") - F.col("own")
    both = (F.col("a") < 0) & (F.col("b") < 0)
    log = lambda x: F.log10(x.cast("double"))
    seen = F.col("own") * (log(others) - F.coalesce("log_a", log(F.col("meeting"))))
    back = F.col("own") * (F.lit(float(np.log10(ALPHA))) + F.coalesce("log_b", log(F.col("meeting"))) - F.lit(float(np.log10(max(total, 1)))))
    # a pair of two rare words is met twice: with its context it counts if seen, with its target if not
    uses_seen = (others > 0) & ~(both & (F.col("side") == 1))
    uses_back = (others <= 0) & ~(both & (F.col("side") == 2))
    final = F.col("side") == 3
    part = met.select(
        "key",
        F.when(final, F.col("given")).when(uses_seen, seen).when(uses_back, back).otherwise(F.lit(0.0)).alias("part"),
        F.when(final, F.col("b")).when(uses_back, F.col("own")).otherwise(F.lit(0)).cast("long").alias("backed"),
        F.when(final, F.col("own")).otherwise(F.lit(0)).cast("long").alias("n"),
    )
    with small_batches(spark, BATCH):
        sums = written(part.groupBy("key").agg(F.sum("part").alias("part"), F.sum("backed").alias("backed"), F.sum("n").alias("n")), "pair-sums")
    copies = rows.groupBy("id", "key").agg(F.count(F.lit(1)).alias("copies"))
    out = copies.join(sums, "key", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    share = lambda c: F.coalesce((F.col(c) / F.col("copies")).cast("long"), F.lit(0))
    return out.select(F.col("id").alias(id_col), share("n").alias("n_predictions"), share("backed").alias("n_backoff"), F.round(F.col("part") / F.col("n"), 6).alias("mean_log10"))
