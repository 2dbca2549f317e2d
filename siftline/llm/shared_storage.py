"""Where intermediate tables go, so that a lost executor costs one stage and not the whole lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests) gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder would lose rows with its machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="siftline-"))
    return sc.getCheckpointDir()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut, columns stay prunable."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint, for the small tables of iterative jobs (Spark removes it with its DataFrame)."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def small_batches(spark: SparkSession, size: str) -> Iterator[None]:
    """Arrow batches of at most ``size`` for the jobs run inside, where tasks hold several times their batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)
