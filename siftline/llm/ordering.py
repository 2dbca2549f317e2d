"""Ranks and neighbours in a total order without a single-partition window.

Rows are range-partitioned once; the partition number is written beside them, so it stays the same when a lost
executor's tasks are computed again. Everything after that works per block plus one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.shared_storage import written

BLOCK = "_block"


def in_blocks(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` written with ``_block``: blocks are contiguous ranges of ``order``, numbered in that order."""
    return written(df.repartitionByRange(*order).withColumn(BLOCK, F.spark_partition_id()), name)


def with_running_total(blocks: DataFrame, group: list[str], order: list[Column], amount: str, out: str) -> DataFrame:
    """``out``: the sum of ``amount`` over the rows of the same ``group`` that come earlier in ``order``.

    A group's rows are summed per block, so a group that holds a third of all rows is spread over as many tasks as
    it has blocks. The table of block sums has at most groups x blocks rows.
    """
    keys = [*group, BLOCK]
    sums = blocks.groupBy(*keys).agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(*group).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = blocks.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    joined = local.alias("l").join(sums.alias("s"), on=[F.col(f"l.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    kept = [F.col(f"l.{c}") for c in blocks.columns if c != BLOCK]
    return joined.select(*kept, (F.col("l._inside") + F.col("s._before")).alias(out))


def with_next(blocks: DataFrame, key: str, order: list[Column], out: str) -> DataFrame:
    """``out``: a struct holding the following row's ``key`` in ``order``; the last row is followed by the first."""
    local = Window.partitionBy(BLOCK).orderBy(*order)
    rows = blocks.withColumn("_next", F.lead(F.struct(key)).over(local)).withColumn("_rank", F.row_number().over(local))
    firsts = rows.filter("_rank = 1").select(BLOCK, F.struct(key).alias("_first"))  # one row a block
    every = Window.orderBy(BLOCK)
    firsts = firsts.withColumn("_start", F.first("_first").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = firsts.select(F.col(BLOCK).alias("_b"), F.coalesce(F.lead("_first").over(every), "_start").alias("_after"))
    joined = rows.join(firsts, F.col(BLOCK) == F.col("_b"))
    return joined.select(*[c for c in blocks.columns if c != BLOCK], F.coalesce("_next", "_after").alias(out))
