"""A table as versions with one pointer: a version is written whole, counted, and only then made the current one.

Readers follow the pointer, a file that is swapped in one rename, so they see a whole version or the one before it. All
of it goes through Hadoop's file systems, wherever the folder lies.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POINTER = "_current"


class VersionError(RuntimeError):
    """A version that isn't there, or that doesn't hold what was written."""


def _path(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, place: str) -> str:
    """``place`` as an address that tasks on other machines can take: with its file system, from the root."""
    path, fs = _path(spark, place)
    out = fs.makeQualified(path).toString()
    return out.replace("file:/", "file:///", 1) if out.startswith("file:/") and not out.startswith("file://") else out


def made(spark: SparkSession, folder: str) -> str:
    """The qualified address of a folder, which is made if it isn't there."""
    path, fs = _path(spark, folder)
    fs.mkdirs(path)
    return qualified(spark, folder)


def exists(spark: SparkSession, place: str) -> bool:
    path, fs = _path(spark, place)
    return fs.exists(path)


def read_text(spark: SparkSession, place: str) -> str | None:
    """The whole of a small file, or none if it isn't there."""
    path, fs = _path(spark, place)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return bytes(stream.readNBytes(1 << 20)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, place: str, text: str) -> None:
    """A small file, whole or not at all: written beside its place and renamed over what is there."""
    jvm = spark._jvm
    part, fs = _path(spark, f"{place}.{uuid.uuid4().hex}")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri() if part.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()).rename(part, _path(spark, place)[0], how)


def folders(spark: SparkSession, place: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if it isn't there."""
    path, fs = _path(spark, place)
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else []


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Names of the whole versions of a table, oldest first."""
    folder = folder.rstrip("/")
    return [v for v in folders(spark, folder) if v.startswith("v") and exists(spark, f"{folder}/{v}/_SUCCESS")]


def current(spark: SparkSession, folder: str) -> str | None:
    """The name of the current version."""
    return read_text(spark, f"{folder.rstrip('/')}/{POINTER}")


def write(df: DataFrame, folder: str) -> str:
    """Write ``df`` as the new current version and return its path; the one before stays as the backup."""
    spark, folder, seen = df.sparkSession, folder.rstrip("/"), Observation()
    name = f"v{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{folder}/{name}")
    held = spark.read.schema(df.schema).parquet(f"{folder}/{name}").count()
    if held != seen.get["rows"]:
        raise VersionError(f"{folder}/{name} holds {held} rows of {seen.get['rows']}; the pointer stays where it is")
    write_text(spark, f"{folder}/{POINTER}", name)
    return f"{folder}/{name}"


def read(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """The current version, or a named one."""
    name = version or current(spark, folder)
    if name is None or name not in versions(spark, folder):
        raise VersionError(f"{folder} has no version {name}" if name else f"{folder} has no current version")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}")


def restore(spark: SparkSession, folder: str, version: str) -> None:
    """Make an earlier version the current one; nothing is copied or lost."""
    if version not in versions(spark, folder):
        raise VersionError(f"{folder} has no version {version}")
    write_text(spark, f"{folder.rstrip('/')}/{POINTER}", version)


def expire(spark: SparkSession, folder: str, keep: int) -> list[str]:
    """Remove all but the current version and the ``keep`` newest others; returns the names of those that went.

    Versions that were never finished count as others. Someone who still reads an expired version loses it.
    """
    if keep < 0:
        raise ValueError("keep at least none")
    now, folder = current(spark, folder), folder.rstrip("/")
    others = [v for v in folders(spark, folder) if v.startswith("v") and v != now]
    gone = others[: max(len(others) - keep, 0)]
    for v in gone:
        path, fs = _path(spark, f"{folder}/{v}")
        fs.delete(path, True)
    return gone
