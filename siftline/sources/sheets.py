"""Readers and writers of company tables. Every reader gives text columns and a ``row_index`` (headers are row 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions.values import clean
from siftline.sources.workbooks import read_xlsx  # noqa: F401

def read_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return with_row_index(spark.read.option("header", True).option("sep", sep).option("multiLine", True).csv(path))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.json(path)
    return with_row_index(df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df if "row_index" in df.columns else with_row_index(df)


def with_row_index(df: DataFrame) -> DataFrame:
    """Gapless row numbers from 2 in file order: offsets of the partitions, not one window over all rows."""
    parts = df.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    sizes = {r["_p"]: r["n"] for r in parts.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a partition
    before, offsets = 2, {}
    for p in sorted(sizes):
        offsets[p] = before
        before += sizes[p]
    if not offsets:
        return df.withColumn("row_index", F.lit(2).cast("int")).select("row_index", *df.columns)
    start = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])[F.col("_p")]
    return parts.select((start + F.col("_i").bitwiseAND(F.lit((1 << 33) - 1))).cast("int").alias("row_index"), *df.columns)


def text_columns(df: DataFrame) -> DataFrame:
    """Every column but ``row_index`` as clean text."""
    return df.select(*[F.col(f"`{c}`") if c == "row_index" else clean(F.col(f"`{c}`")).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
