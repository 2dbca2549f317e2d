"""Journals as streams: records arriving as JSON lines, folded per row of the company table as they come."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from siftline.functions import values as V
from siftline.operators.journal import SCHEMA


def records(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of journal records; files are taken once, in any number of triggers."""
    return spark.readStream.schema(SCHEMA).option("mode", "FAILFAST").json(folder)


def latest_status(stream: DataFrame) -> DataFrame:
    """Per row the status with the largest sequence number so far, and the number of records; state is a row a row."""
    return stream.groupBy("row_index").agg(F.max_by("status", "seq").alias("status"), F.max("seq").alias("seq"), F.count(F.lit(1)).alias("records"))


def status_counts(stream: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Outcomes per window of recording time; a window's counts are final once ``late`` has passed."""
    return stream.withWatermark("recorded_at_utc", late).groupBy(F.window("recorded_at_utc", window), "status").agg(F.count(F.lit(1)).alias("records"))


def fold_available(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Take what has arrived, append it as Parquet and stop; a restart goes on where the last one ended."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


FOLDED = "row_index int, status string, records long, any_result boolean, was_reset boolean, " + ", ".join(f"reset_{v} string, first_{v} string" for v in V.CONTACTS)
_HEAD = "seq long, status string, records long, any_result boolean, restart long"
_VALUES = ", ".join(f"{v} string" for v in V.CONTACTS)


class _Replay(StatefulProcessor):
    """A row's journal as far as it has come. Records may come in any order: those with a value are kept by their number
    since the last overwriting one, which drops all before it, so that whatever comes later finds its place."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.head = handle.getValueState("head", _HEAD)
        self.since = handle.getMapState("since", "seq long", _VALUES)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        seq, status, records, any_result, restart = self.head.get() if self.head.exists() else (None, None, 0, False, None)
        for pdf in rows:
            for r in pdf.itertuples(index=False):
                records += 1
                if seq is None or r.seq > seq:
                    seq, status = int(r.seq), r.status
                if not r.has_result:
                    continue
                any_result = True
                overwrites = bool(r.overwrite_existing)
                if overwrites and (restart is None or r.seq > restart):
                    restart = int(r.seq)
                    for (old,) in [k for k in self.since.keys() if k[0] < restart]:
                        self.since.removeKey((old,))
                if restart is None or r.seq >= restart:
                    self.since.updateValue((int(r.seq),), tuple(getattr(r, v) for v in V.CONTACTS))
        self.head.update((seq, status, records, any_result, restart))
        held = sorted((k[0], tuple(v)) for k, v in self.since.iterator())
        out = {"row_index": key[0], "status": status, "records": records, "any_result": any_result, "was_reset": restart is not None}
        for i, v in enumerate(V.CONTACTS):
            out[f"reset_{v}"] = next((x[i] for n, x in held if n == restart), None)
            out[f"first_{v}"] = next((x[i] for _, x in held if x[i] is not None and x[i] != V.MISSING), None)
        yield pd.DataFrame([out])

    def close(self) -> None:
        pass


def replayed(stream: DataFrame) -> DataFrame:
    """Per row what ``journal.folded`` gives for the records so far, anew whenever records of the row arrive.

    Keyed state under RocksDB: a row's last status and, since its last overwriting record, the records with a result, one
    a run; older ones are dropped, so state doesn't grow with a history that starts afresh. Records of one row may come in
    any order and in any trigger; a record that comes twice counts twice, so sources must give each once. Null row numbers
    are left out. The session needs the RocksDB state store.
    """
    flat = [F.col(f"result.{v}").alias(v) for v in V.CONTACTS]
    rows = stream.filter("row_index IS NOT NULL AND seq IS NOT NULL").select("row_index", "seq", "status", F.col("result").isNotNull().alias("has_result"), "overwrite_existing", *flat)
    return rows.groupBy("row_index").transformWithStateInPandas(_Replay(), FOLDED, "Update", "None")
