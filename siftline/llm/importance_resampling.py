"""Quality by importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k on their ratio.

Target text is a bounded sample of rows labelled good, raw text is every document. A document's log weight is the sum
over its n-grams of log p_target - log p_raw, tempered to ``EVIDENCE`` n-grams where it has more: n-grams of a text are
not independent, and untempered sums of long texts would outweigh any noise. Adding standard Gumbel noise and keeping
the k largest draws k documents without replacement in proportion to their weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.labelled import sampled_labels, with_sample
from siftline.llm.shared_storage import written
from siftline.llm.word_hashes import WHITE, pair, word_batches

#: Hash buckets of each order (a power of two).
BUCKETS = 1 << 13
FEATURES = 2 * BUCKETS + 2
#: Labelled rows of each class that are used at most.
LABELS_A_CLASS = 10_000
#: A longer text weighs as if it had so many n-grams with its mean log ratio.
EVIDENCE = 40
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_BINS = 1024


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, row of each feature counted from the first, feature) of whole texts.

    Features are buckets of words and runs of punctuation, buckets of pairs of them, and for each word whether it
    repeats one of the two before it (the n-grams of a loop are as rare as any, their repetition is not).
    """
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    is_mark = np.zeros(256, bool)
    is_mark[list(MARKS)] = True
    for first, last, w in word_batches(texts, WHITE, marks=MARKS):
        h, d = w.hash, w.doc
        again, wordlike = np.zeros(len(h), bool), ~is_mark[w.data[w.start]]
        for k in (1, 2):
            again[k:] |= (h[k:] == h[:-k]) & (d[k:] == d[:-k]) & wordlike[k:]
        together = d[1:] == d[:-1]
        pairs = pair(h[:-1], h[1:])[together]
        one, two = (h >> shift).astype(np.int64), (pairs >> shift).astype(np.int64) + BUCKETS
        yield first, last, np.concatenate((d, d[1:][together], d)), np.concatenate((one, two, 2 * BUCKETS + again))


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw of each feature, add-one smoothed within each order; 0 where there is no target text."""
    out = np.zeros(FEATURES)
    if target.sum() == 0:
        return out
    for a, b in ((0, BUCKETS), (BUCKETS, 2 * BUCKETS), (2 * BUCKETS, FEATURES)):
        t, r = target[a:b] + 1.0, raw[a:b] + 1.0
        out[a:b] = np.log(t / t.sum()) - np.log(r / r.sum())
    return out


def tempered(sums: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log weights from sums over ``n`` n-grams each: ``EVIDENCE`` times the mean, for shorter texts the sum itself."""
    return sums * np.minimum(1.0, EVIDENCE / np.maximum(n, 1))


def gumbel_key(log_weight: Column, seed: int, *identity: Column | str) -> Column:
    """The log weight plus standard Gumbel noise, which the seed and a row's identity decide."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *identity), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return log_weight - F.log(-F.log(uniform))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, np.int64)
    for batch in batches:
        good = batch.column(1).fill_null(0).to_numpy() == 1
        for first, last, row, feature in features(batch.column(0)):
            raw += np.bincount(feature, minlength=FEATURES)
            target += np.bincount(feature[good[first:last][row]], minlength=FEATURES)
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], names=["feature", "raw", "target"])


def weigh(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """(id, text_hash, label, log_weight, key) of every row, written; key is the log weight plus seeded Gumbel noise.

    The model is FEATURES numbers: it is summed over all documents and all its labelled rows, and shipped to tasks.
    """
    rows = with_sample(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), sample, "left", "id")
    sums = rows.select("text", "_label").mapInArrow(_counts, "feature long, raw long, target long").groupBy("feature").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(FEATURES), np.zeros(FEATURES)
    for r in sums.collect():  # at most FEATURES rows
        raw[r.feature], target[r.feature] = r.raw, r.target
    model = docs.sparkSession.sparkContext.broadcast(log_ratio(target, raw))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = np.zeros(batch.num_rows)
            for first, last, row, feature in features(batch.column(0)):
                sums = np.bincount(row, weights=model.value[feature], minlength=last - first)
                weight[first:last] = tempered(sums, np.bincount(row, minlength=last - first))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(weight)], names=["id", "text_hash", "label", "log_weight"])

    kind = rows.schema["id"].dataType.simpleString()
    texts = rows.select("text", "id", F.xxhash64(F.coalesce("text", F.lit(""))), "_label")
    scored = texts.mapInArrow(score, f"id {kind}, text_hash long, label int, log_weight double")
    return written(scored.withColumn("key", gumbel_key(F.col("log_weight"), seed, "id", "text_hash")), "weights")


def kth_largest(rows: DataFrame, k: int, column: str = "key") -> float:
    """The k-th largest value of a double column: counts per bin of an ever smaller range, never the rows."""
    values = rows.filter(F.col(column).isNotNull())
    low, high, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
    if k <= 0 or not n:
        return math.inf
    if k >= n:
        return low
    while True:
        width = (high - low) / _BINS
        if width <= 0 or low + width == low:
            return high if low == high else _settle(values, column, low, high, k)
        part = values.filter((F.col(column) >= low) & (F.col(column) <= high))
        bins = F.least(F.floor((F.col(column) - low) / width), F.lit(_BINS - 1))
        counts = part.groupBy(bins.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy(F.desc("bin")).collect()
        for b in counts:
            if k <= b.n:
                low, high = b.low, b.high
                break
            k -= b.n
        if low == high or k == b.n:
            return low


def _settle(values: DataFrame, column: str, low: float, high: float, k: int) -> float:
    """A range too narrow for bins has few distinct values."""
    for r in values.filter((F.col(column) >= low) & (F.col(column) <= high)).groupBy(column).count().orderBy(F.desc(column)).collect():
        if k <= r["count"]:
            return r[column]
        k -= r["count"]
    return low


def gumbel_top_k(weighted: DataFrame, k: int) -> DataFrame:
    """``weighted`` with ``selected``: whether the key is among the k largest; rows tied with the k-th all stay."""
    return weighted.withColumn("selected", F.col("key") >= F.lit(kth_largest(weighted, k)))


def acceptable(weighted: DataFrame) -> int:
    """k from the labels: the number of all rows whose key is above the cut that best separates the labelled ones.

    The cut is the middle of the gap with the fewest labelled rows on the wrong side, shares of each class counting
    alike. With one class only, k is all rows: nothing shows what to reject. Of rows that share a labelled id the one
    with the least text hash counts, so there are no more than the sample has ids.
    """
    one = weighted.filter("label IS NOT NULL").groupBy("id").agg(F.min(F.struct("text_hash", "key", "label")).alias("r"))
    known = sorted((r.key, r.label) for r in one.select("r.key", "r.label").collect())  # bounded by the labels' sample
    good, bad = sum(y for _, y in known), sum(1 - y for _, y in known)
    if not good or not bad:
        return weighted.count()
    lost, let_in, best, cut = 0.0, 1.0, 1.0, -math.inf
    for (key, y), (after, _) in zip(known, [*known[1:], (math.inf, 1)], strict=True):
        lost, let_in = lost + y / good, let_in - (1 - y) / bad
        if key < after and lost + let_in < best:
            best, cut = lost + let_in, (key + after) / 2
    return weighted.filter(F.col("key") >= cut).count()


def select(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", labels_a_class: int = LABELS_A_CLASS, k: int | None = None, seed: int = 7) -> DataFrame:
    """(id, text_hash, label, log_weight, key, selected) of every row of ``docs``.

    ``k`` rows are drawn; unset, labels set it (``acceptable``).

    ``labels`` has the id and quality 0 or 1; null labels and ids are no labels. Null and empty texts weigh nothing:
    their key is the noise alone. Repeated rows get equal keys and are selected together. An empty table stays empty,
    and without labels of both classes every row is selected.
    """
    weighted = weigh(docs, sampled_labels(labels, "quality", labels_a_class), id_col, text_col, seed)
    return gumbel_top_k(weighted, acceptable(weighted) if k is None else k)


def keep_selected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``select`` selects, with their columns, whatever their names; repeated rows go together."""
    chosen = select(docs, labels, id_col, text_col).filter("selected").select(F.col("id").alias("_id"), F.col("text_hash").alias("_h")).distinct()
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    keyed = docs.toDF(*place.values()).withColumn("text_hash", F.xxhash64(F.coalesce(F.col(place[text_col]), F.lit(""))))
    hit = keyed.join(chosen, keyed[place[id_col]].eqNullSafe(chosen["_id"]) & (keyed["text_hash"] == chosen["_h"]), "left_semi")
    return hit.select(*place.values()).toDF(*docs.columns)
