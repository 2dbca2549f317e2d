"""Bounded samples of labelled rows, the only data that models are fitted on driver-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sampled_labels(labels: DataFrame, label_col: str, bound: int, where: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """(id, label): of each class 0 and 1, the ``bound`` ids with the smallest hash; an id labelled twice counts as 1."""
    rows = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if where is not None:
        rows = rows.filter(where)
    rows = rows.groupBy(F.col(id_col).alias("_label_id")).agg(F.max(label_col).cast("int").alias("_label"))
    order = [F.xxhash64("_label_id"), F.col("_label_id")]
    return rows.filter("_label = 0").orderBy(*order).limit(bound).union(rows.filter("_label = 1").orderBy(*order).limit(bound))


def with_sample(docs: DataFrame, sample: DataFrame, how: str, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``_label``; the sample has at most two times its bound rows, so every task can hold it."""
    return docs.join(F.broadcast(sample), docs[id_col] == sample["_label_id"], how).drop("_label_id")
