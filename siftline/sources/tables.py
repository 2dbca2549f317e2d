"""Reading tables for work that is heavy per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Scans with fewer tasks than this are dealt out to more; at the usual split size they hold a gigabyte at most.
FEW_TASKS = 8


#: Rows of a table that is dealt out that one task gets at most, about.
ROWS_A_TASK = 20_000


def dealt(df: DataFrame) -> DataFrame:
    """``df`` over all cores, and over more tasks where it is long, however few files or row groups hold it: for short
    rows that much is made of."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_TASK)))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``. A small one in few splits is dealt over the cores, where parsing or tokenizing its rows
    would else run in a task or two; a large one has splits enough and is read as it lies."""
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < min(FEW_TASKS, cores):
        df = df.repartition(min(cores, 4 * FEW_TASKS))
    return df
