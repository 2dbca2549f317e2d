"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is logistic in its hashed words and their beginnings (stems, whatever their endings). A document is toxic unless each of its sentences is not
(noisy-or), so gradients of the document's likelihood reach the sentences that explain its label, and these can be
pointed at afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftline.llm.labelled import sampled_labels, with_sample
from siftline.llm.word_hashes import WHITE_AND_PUNCTUATION, Words, word_batches

#: Hash buckets; one more, always of weight 0, stands for beginnings that a word is too short for.
BUCKETS = 1 << 18
PREFIXES = (4, 5, 6)  # bytes
#: Labelled rows of each class that training uses at most; they reach the driver as hashed features.
LABELS_A_CLASS = 1_500
ROUNDS, RATE, RIDGE = 150, 0.15, 1e-5
#: A feature is used if at least so many documents have it, and toxic and other documents differ by so many deviations.
RARE, SCREEN = 3, 5.0
_ENDS = b".!?\n"


class Model(NamedTuple):
    weights: np.ndarray  # of each bucket
    bias: float


def sentences(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of each word, one row a word; each sentence's first word); sentences end at . ! ? and line ends."""
    ends = np.zeros(256, bool)
    ends[list(_ENDS)] = True
    passed = np.cumsum(ends[w.data])[w.start] if len(w.start) else w.start
    new = np.ones(len(w.start), bool)
    new[1:] = (w.doc[1:] != w.doc[:-1]) | (passed[1:] != passed[:-1])
    shift, bucket = np.uint64(65 - BUCKETS.bit_length()), np.empty((len(w.start), 1 + len(PREFIXES)), np.int32)
    bucket[:, 0] = w.hash >> shift
    for i, n in enumerate(PREFIXES, 1):
        longer, hashes = w.prefix_hashes(n)
        bucket[:, i] = np.where(longer, (hashes >> shift).astype(np.int32), BUCKETS)
    return bucket, np.flatnonzero(new)


def sentence_logits(model: Model, bucket: np.ndarray, first: np.ndarray) -> np.ndarray:
    words = model.weights[bucket].sum(axis=1, dtype=np.float64)
    return np.clip((np.add.reduceat(words, first) if len(first) else np.zeros(0)) + model.bias, -30, 30)


def fit(bucket: np.ndarray, first: np.ndarray, document: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Model:
    """Adam on the weighted noisy-or likelihood. ``document`` is each sentence's, counted from 0; labels are documents'."""
    model = np.zeros(BUCKETS + 1)
    if not len(first) or label.min() == label.max():
        return Model(model, 20.0 if len(label) and label.min() == 1 else -20.0)
    sentence = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(bucket))))
    owner, column = np.repeat(sentence, bucket.shape[1]), bucket.ravel()
    n, toxic = len(label), int(label.sum())
    having, having_toxic = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)
    edges = np.searchsorted(document[owner[:: bucket.shape[1]]], np.arange(n + 1)) * bucket.shape[1]
    for d in range(n):
        seen = np.unique(column[edges[d] : edges[d + 1]])
        having[seen] += 1
        having_toxic[seen] += label[d]
    spread = np.sqrt(np.maximum(having / n * (1 - having / n), 1e-9) * (1 / toxic + 1 / (n - toxic)))
    common = (having >= RARE) & (np.abs(having_toxic / toxic - (having - having_toxic) / (n - toxic)) > SCREEN * spread)
    common[BUCKETS] = False
    use = common[column]
    names, column = np.flatnonzero(common), (np.cumsum(common) - 1)[column[use]]
    owner = owner[use]
    theta = np.zeros(len(names) + 1)
    theta[-1] = np.log((weight * label).sum() / weight.sum() * len(label) / len(first))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, ROUNDS + 1):
        z = np.clip(np.bincount(owner, weights=theta[column], minlength=len(first)) + theta[-1], -30, 30)
        clean = np.bincount(document, weights=-np.logaddexp(0, z), minlength=len(label))  # log of: no sentence is toxic
        odds = np.where(label == 1, np.exp(clean) / np.maximum(-np.expm1(clean), 1e-12), -1.0) * weight
        g = odds[document] / (1 + np.exp(-z))
        grad = np.append(np.bincount(column, weights=g[owner], minlength=len(names)), g.sum()) / weight.sum()
        grad[:-1] -= RIDGE * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta += RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    model[names] = theta[:-1]
    return Model(model, float(theta[-1]))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, w in word_batches(batch.column(0), WHITE_AND_PUNCTUATION):
            bucket, starts = sentences(w)
            words, cuts = np.searchsorted(w.doc, np.arange(last - first + 1)), np.searchsorted(w.doc[starts], np.arange(last - first + 1))
            out = [(bucket[a:b].tobytes(), (starts[c:d] - a).astype(np.int32).tobytes()) for a, b, c, d in zip(words[:-1], words[1:], cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, last - first), pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.binary())], names=["label", "words", "starts"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", labels_a_class: int = LABELS_A_CLASS) -> Model:
    """Fit on at most ``labels_a_class`` rows of each class whose crc32(id as text) mod 5 is not 0.

    Classes weigh as they occur among all such labels, so that 0.5 is an even chance.
    """
    teaching = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0
    shares = {r["toxic"]: r["n"] for r in labels.filter(teaching & F.col("toxic").isin(0, 1)).groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = sampled_labels(labels, "toxic", labels_a_class, teaching, id_col)
    rows = with_sample(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), sample, "inner", "id")
    found = rows.select("text", "_label").mapInArrow(_hashed, "label int, words binary, starts binary").collect()  # 2 x labels_a_class rows
    found.sort(key=lambda r: (r.label, r.words, r.starts))
    words = [np.frombuffer(r.words, np.int32).reshape(-1, 1 + len(PREFIXES)) for r in found]
    starts = [np.frombuffer(r.starts, np.int32) for r in found]
    label = np.array([r.label for r in found], np.int64)
    at = np.cumsum([0, *map(len, words)])
    weight = np.array([shares.get(y, 0) for y in (0, 1)], float) / np.maximum(np.bincount(label, minlength=2), 1)
    first = np.concatenate([s + a for s, a in zip(starts, at, strict=False)]) if found else np.zeros(0, np.int64)
    document = np.repeat(np.arange(len(found)), [len(s) for s in starts])
    return fit(np.concatenate(words) if found else np.zeros((0, 1), np.int32), first.astype(np.int64), document, label, weight[label])


def score(docs: DataFrame, model: Model, text_col: str = "text", locate: bool = False, threshold: float = 0.5, keep_text: bool = False) -> DataFrame:
    """``docs`` without its text (with ``keep_text``: with it, last), with score double and predicted int, and if ``locate`` the offending sentences.

    ``offending`` holds (start, end, score, text) of the sentences whose own probability is at least ``threshold``
    (character positions, first word to last), of every whole text. A null or wordless text has score 0. Columns named
    like a result are left out.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(Model(model.weights.astype(np.float32), model.bias))
    own = [c for c in docs.columns if c not in (text_col, "score", "predicted", "offending")]
    spans = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, where = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            for first, last, w in word_batches(batch.column(batch.num_columns - 1), WHITE_AND_PUNCTUATION):
                bucket, starts = sentences(w)
                z = sentence_logits(shipped.value, bucket, starts)
                p = 1 / (1 + np.exp(-z))
                total[first:last] = -np.expm1(np.bincount(w.doc[starts], weights=-np.logaddexp(0, z), minlength=last - first))
                for s in np.flatnonzero(p >= threshold).tolist() if locate else ():
                    to = (starts[s + 1] if s + 1 < len(starts) else len(w.start)) - 1
                    a, b, d = w.start[starts[s]], w.end[to], w.doc[starts[s]]
                    before, text = bytes(w.data[w.doc_start[d] : a]).decode(), bytes(w.data[a:b]).decode()
                    where[first + d].append({"start": len(before), "end": len(before) + len(text), "score": float(p[s]), "text": text})
            predicted = (total >= 0.5).astype(np.int32)
            columns = [*(batch.columns if keep_text else batch.columns[:-1]), pa.array(total), pa.array(predicted)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(where, pa.list_(spans))] * locate, names=names)

    made = "score double, predicted int" + ", offending array<struct<start: bigint, end: bigint, score: double, text: string>>" * locate
    read = docs.select(*own, text_col)
    schema = StructType([*(read if keep_text else read.select(*own)).schema.fields, *StructType.fromDDL(made).fields])
    names = schema.names
    return read.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Whether training never sees the row: crc32(id as text) mod 5 is 0; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model trained on them does not predict toxic, with their columns."""
    model = train(docs, labels, id_col, text_col)
    plain = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    kept = score(docs.withColumnsRenamed(plain), model, plain[text_col], keep_text=True).filter("predicted = 0")
    return kept.select(*[F.col(name).alias(c) for c, name in plain.items()])
