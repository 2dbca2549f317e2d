"""Importance resampling towards a target's distribution of word n-grams, by partition-local word tries.

A feature is a run of one to three consecutive words; it is a path of a word trie whose nodes are numbered by
(parent, word). A node holds how often its path occurs and the CRC-32 state after its bytes, so a child's state takes
the bytes of one more word alone, and a path that occurs a thousand times in a chunk of texts is hashed once. Tries live
for one chunk of whole texts; what leaves a task are the totals of its buckets. With the totals of both tables each
bucket has a gain, documents walk their paths again, and every node carries the gain of its bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.ordering import in_blocks, with_running_total
from siftline.llm.shared_storage import written
from siftline.llm.word_hashes import word_batches

ORDERS = 3
BUCKETS = 10_000
SEED = 42
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
DRAWN_PERCENT = 5
#: Bytes that are no part of a word: all of ASCII but digits and letters.
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
_CHUNK_BYTES = 1 << 21
#: Words up to this many bytes, with the space before them, are appended to CRC states by table.
_TABLED = 64


def _after_zeros() -> np.ndarray:
    """[n, k, v]: what byte k of a CRC-32 state, of value v, becomes after n zero bytes; a state is the xor of its bytes'."""
    step = np.arange(256, dtype=np.int64)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ 0xEDB88320, step >> 1)
    out = [np.arange(256, dtype=np.int64) << np.array([[0], [8], [16], [24]])]
    for _ in range(_TABLED):
        out.append(step[out[-1] & 255] ^ out[-1] >> 8)
    return np.stack(out)


_ZEROS = _after_zeros()


def appended(state: np.ndarray, word: np.ndarray, spaced: list[bytes]) -> np.ndarray:
    """CRC-32 of texts with CRC-32 ``state``, each followed by ``spaced[word]``."""
    length, own = np.array([len(x) for x in spaced], np.int64), np.array([crc32(x) for x in spaced], np.int64)
    n = np.minimum(length[word], _TABLED)
    out = own[word]
    for k in range(4):
        out ^= _ZEROS[n, k, state >> 8 * k & 255]
    for i in np.flatnonzero(length[word] > _TABLED).tolist():
        out[i] = crc32(spaced[word[i]], int(state[i]))
    return out


class Level(NamedTuple):
    """The nodes of one depth of a trie and the paths through them."""

    state: np.ndarray  # of each node: CRC-32 of its words, joined by one space
    node: np.ndarray  # of each path: the node it ends in
    row: np.ndarray  # of each path: the text it is in

    def counts(self) -> np.ndarray:
        return np.bincount(self.node, minlength=len(self.state))


def _numbered(keys: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of each key, distinct keys) in order of appearance, compared exactly."""
    found = keys.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def _words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The words as binary values, upper-case ASCII letters lowered."""
    length = end - start
    offsets = np.concatenate(([0], np.cumsum(length)))
    at = np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])
    held = data[at]
    held = np.where((held >= 65) & (held <= 90), held + 32, held).astype(np.uint8)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(held)])


def tries(texts: pa.Array, chunk_bytes: int = _CHUNK_BYTES) -> Iterator[tuple[int, int, list[Level]]]:
    """(first row, row after the last, levels 1 to 3) of chunks of whole texts; rows count from the first of the chunk.

    Null and empty texts have no words. Memory follows the chunk or the longest single text.
    """
    for first, last, w in word_batches(texts, SEPARATORS, chunk_bytes):
        word, distinct = _numbered(_words(w.data, w.start, w.end))
        plain = distinct.to_pylist()
        spaced = [b" " + x for x in plain]
        row, node = w.doc, word
        levels = [Level(np.array([crc32(x) for x in plain], np.int64), node, row)]
        for depth in range(1, ORDERS):
            # a path goes on by the word after it, inside the same text
            whole = np.flatnonzero(row[: max(len(word) - depth, 0)] == w.doc[depth:])
            node, keys = _numbered(pa.array(node[whole] * len(plain) + word[whole + depth]))
            parent, child = divmod(keys.to_numpy(), max(len(plain), 1))
            levels.append(Level(appended(levels[-1].state[parent], child, spaced), node, row[whole]))
            node, row = _in_place(node, whole, len(word)), _in_place(row[whole], whole, len(word))
        yield first, last, levels


def _in_place(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """``values`` at the positions of the words their paths begin with; elsewhere -1, a row that no text has."""
    out = np.full(n, -1, np.int64)
    out[at] = values
    return out


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, levels in tries(batch.column(0)):
            for level in levels:
                np.add.at(total, level.state % BUCKETS, level.counts())
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])


def bucket_totals(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket; a task gives its totals, so at most BUCKETS rows are collected."""
    sums = texts.select(F.col(text_col)).mapInArrow(_totals, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in sums.collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of add-one smoothed shares in the target and in all texts, rounded down."""
    s_all, t_all = int(raw.sum()), int(target.sum())
    ratio = lambda s, t: float(t + 1) * float(s_all + BUCKETS) / (float(s + 1) * float(t_all + BUCKETS))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def _weigher(gain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, last, levels in tries(batch.column(1)):
                for depth, level in enumerate(levels):
                    n = np.bincount(level.row, minlength=last - first)
                    features[first:last] += n
                    if depth == 0:
                        words[first:last] = n
                    np.add.at(weight[first:last], level.row, gain.value[level.state % BUCKETS][level.node])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(features), pa.array(weight)], names=["id", "n_words", "n_features", "weight"])

    return run


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Thousandths of standard Gumbel noise, rounded down, from the first 32 bits of SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; rank numbers the drawn rows, null for others.

    Of the N rows with at least LEAST_WORDS words floor(percent * N / 100) are drawn by the highest score, ties by the
    smaller id. Null ids come after all others of their score and draw the noise of the id ``null``. Null and empty
    texts have no features and weigh 0. Rows that share an id share its noise; repeated rows are rows of their own and
    take ranks one after another. Empty tables give no rows; with no target text all gains follow from smoothing alone.
    Other columns are not read, whatever their names.
    """
    gain = docs.sparkSession.sparkContext.broadcast(gains(bucket_totals(docs, text_col), bucket_totals(target, target_text_col)))
    kind = docs.schema[id_col].dataType.simpleString()
    weighed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(_weigher(gain), f"id {kind}, n_words long, n_features long, weight long")
    scored = written(weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)).withColumn("one", F.lit(1)), "trie-weights")
    draw = scored.filter(F.col("n_words") >= LEAST_WORDS).count() * percent // 100
    order = [(F.col("n_words") < LEAST_WORDS).asc(), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("weight").asc(), F.col("n_features").asc()]
    ranked = with_running_total(in_blocks(scored, order, "trie-ranks"), [], order, "one", "before")
    rank = F.when(F.col("before") < draw, F.col("before") + 1).cast("long").alias("rank")
    return ranked.select(F.col("id").alias(id_col), "n_features", "weight", "score", rank)
