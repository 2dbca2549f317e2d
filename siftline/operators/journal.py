"""The journal of outcomes: written before the table changes, replayed in order if a run broke off."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.functions import values as V

SCHEMA = (
    "seq long, version int, recorded_at_utc timestamp, row_index int, siret string, company_name string, "
    "result struct<email: string, phone: string, website: string, website_type: string, sources: array<string>, email_source: string, phone_source: string, website_source: string>, "
    "status string, overwrite_existing boolean, error_type string, error_message string"
)


class JournalError(RuntimeError):
    """A journal that can't be replayed: a bad line, or a record of another company."""


def append(records: DataFrame, path: str, mode: str = "append") -> None:
    """Records as JSON lines; messages keep 500 characters."""
    records.withColumn("error_message", F.substring("error_message", 1, 500)).write.mode(mode).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of a journal, a file or a folder of them at any depth; blank lines are skipped, unknown keys and bad lines
    make it unreadable."""
    place = {"file": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start"), "at": F.monotonically_increasing_id()}
    lines = spark.read.option("recursiveFileLookup", True).text(path).select("value", *[c.alias(n) for n, c in place.items()])
    known = [f.split()[0].rstrip(":") for f in ("seq", "version", "recorded_at_utc", "row_index", "siret", "company_name", "result", "status", "overwrite_existing", "error_type", "error_message")]
    keys = F.json_object_keys("value")
    bad = (F.btrim("value") != "") & (keys.isNull() | (F.size(F.array_except(keys, F.array(*map(F.lit, known)))) > 0))
    if not lines.filter(bad).isEmpty():
        first = _numbered(lines, bad).orderBy("file", "line").first()
        raise JournalError(f"line {first.line} of {first.file} can't be read")
    records = lines.filter(F.btrim("value") != "").select(F.from_json("value", SCHEMA, {"mode": "FAILFAST"}).alias("r"))
    return records.select("r.*")


def _numbered(lines: DataFrame, which: Column) -> DataFrame:
    """(file, line from 1) of some lines: places within a block after the lines of the file's blocks before it."""
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return lines.filter(which).join(blocks, ["file", "block"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"))


def mismatches(journal: DataFrame, sheet: DataFrame) -> DataFrame:
    """Records whose row belongs to another company than when they were written."""
    s = sheet.select("row_index", F.col("siret").alias("s_siret"), F.col("company_name").alias("s_name"))
    same = (V.digits(F.col("siret")) == V.digits(F.coalesce("s_siret", F.lit("")))) & (F.lower(F.btrim("company_name")) == F.lower(F.btrim(F.coalesce("s_name", F.lit("")))))
    return journal.join(s, "row_index", "left").filter(~F.coalesce(same, F.lit(False))).drop("s_siret", "s_name")


def folded(journal: DataFrame, values: tuple[str, ...] = V.CONTACTS, order: str = "line_no", keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The journal as one row per table row: what replaying it in ``order`` comes to.

    Per value: ``reset_<v>`` is the value of the last overwriting record with a result, null if there is none, and
    ``first_<v>`` the first value found from there on (or at all). Min and max by the order combine map-side, so a row
    with a long history is no longer a task than any other. ``keep`` may write the restarts: a join with a written
    table is one that Spark can split where a row's history is long.
    """
    has = F.col("has_result")
    restart = keep(journal.filter(has & F.col("overwrite_existing")).groupBy("row_index").agg(F.max(order).alias("_restart")))
    rows = journal.join(restart, "row_index", "left")
    since = has & (F.col("_restart").isNull() | (F.col(order) >= F.col("_restart")))
    out = [F.max_by("status", order).alias("status"), F.count(F.lit(1)).cast("long").alias("records"), F.max(has).alias("any_result"), F.max("_restart").isNotNull().alias("was_reset")]
    for v in values:
        out.append(F.max(F.when(F.col(order) == F.col("_restart"), F.col(v))).alias(f"reset_{v}"))
        out.append(F.min_by(v, F.when(since & (F.col(v) != V.MISSING), F.col(order))).alias(f"first_{v}"))
    return rows.groupBy("row_index").agg(*out)


def replayed_value(existing: Column, was_reset: Column, reset: Column, first: Column, any_result: Column) -> Column:
    """A cell after the replay: the last overwrite starts afresh, else what is there stays if it is real."""
    real = F.coalesce(V.clean(existing), F.lit(V.MISSING)) != V.MISSING
    after = F.coalesce(first, F.lit(V.MISSING))
    fresh = F.when(reset != V.MISSING, reset).otherwise(after)
    return F.when(was_reset, fresh).when(~any_result | real, existing).otherwise(after)


def replay(sheet: DataFrame, journal: DataFrame, order: str = "line_no", keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``sheet`` as if each record had been applied in turn; fails as a whole if any is of another company."""
    if "siret" in journal.columns and not mismatches(journal, sheet).isEmpty():
        raise JournalError("the journal holds records of other companies than the table's rows")
    values = tuple(v for v in V.CONTACTS if v in journal.columns)
    f = folded(journal, values, order, keep)
    f = f.withColumnsRenamed({c: f"_{c}" for c in f.columns if c != "row_index"})
    both = sheet.join(f, "row_index", "left")
    new = {v: F.when(F.col("_records").isNull(), F.col(v)).otherwise(replayed_value(F.col(v), F.col("_was_reset"), F.col(f"_reset_{v}"), F.col(f"_first_{v}"), F.col("_any_result"))) for v in values}
    new["status"] = F.coalesce("_status", "status")
    return both.select(*[new.get(c, F.col(c)).alias(c) for c in sheet.columns])


def from_records(records: DataFrame) -> DataFrame:
    """Records as read from a journal in the flat form that ``replay`` takes."""
    flat = [F.col(f"result.{v}").alias(v) for v in V.CONTACTS]
    return records.select(F.col("seq").alias("line_no"), "row_index", "siret", "company_name", "status", F.col("result").isNotNull().alias("has_result"), "overwrite_existing", *flat)
