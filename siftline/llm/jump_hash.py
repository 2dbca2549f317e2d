"""Jump consistent hashing: stable keys to shards, and gapless slots within shards."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from siftline.llm.ordering import in_blocks, with_running_total


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key: the last bucket below ``shards`` that the key's random walk lands on."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state, landed, ahead = keys.astype(np.uint64), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    walking = np.arange(len(keys))
    while len(walking):
        landed[walking] = ahead[walking]
        state[walking] = state[walking] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[walking] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[walking] = ((landed[walking] + 1) * (2147483648.0 / draw)).astype(np.int64)
        walking = walking[ahead[walking] < shards]
    return landed


def shard(key: Column, shards: int) -> Column:
    """int shard in 0 .. ``shards`` - 1 of a long key; a null key counts as 0."""

    @F.pandas_udf("int")
    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return of(F.coalesce(key.cast("long"), F.lit(0)))


def long_key(docs: DataFrame, key_col: str) -> Column:
    """The long that stands for a key: a whole number itself, any other kind the XXH64 of its text; null stays null."""
    kind = docs.schema[key_col].dataType
    if isinstance(kind, IntegralType):
        return F.col(f"`{key_col}`").cast("long")
    text = F.col(f"`{key_col}`").cast("string")
    return F.when(text.isNotNull(), F.xxhash64(text))


def place(docs: DataFrame, shards: int, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``.

    Keys may be of any kind that casts to text (see ``long_key``) and keep theirs as doc_id. Only the key decides the shard, so growing by one shard moves rows into the new shard only. Slots number the
    shard's rows in order of (key with nulls first, size, CRC-32) from 0. Equal rows are counted before they are
    ordered and take consecutive slots. A null text has size 8 and the CRC-32 of nothing; other columns are not read.
    """
    payload = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = docs.select(F.col(f"`{key_col}`").alias("doc_id"), (F.octet_length(payload) + F.lit(8)).cast("long").alias("size"), F.crc32(payload).alias("text_crc32"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32")]
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    blocks = in_blocks(counted, order, "shard-order")
    key = long_key(blocks, "doc_id")
    blocks = blocks.withColumn("shard", shard(key, shards)).withColumn("grown_shard", shard(key, shards + 1))
    ranked = with_running_total(blocks, ["shard"], order, "copies", "before")
    slots = F.explode(F.sequence(F.col("before"), F.col("before") + F.col("copies") - 1))
    return ranked.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slots.alias("slot"), "grown_shard")
