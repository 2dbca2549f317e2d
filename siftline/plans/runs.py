"""The folder of a table's runs: steps that are not done twice, answers that are not paid for twice, journals, marks.

    out/v...            versions of the table, out/_current the pointer to one
    out/runs/run-<n>/   a run: its manifest, its steps, its answers as they came
    out/journal/run-<n>/  JSON lines, written before the table changes
    out/commits/        marks of runs whose table is written

A run that broke off is taken up again by the next one with the same settings and table: steps that are whole are read,
rows that have an answer are not asked again. A run that broke off after its journal is replayed from it.
"""

from __future__ import annotations

import dataclasses
import json
import time
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.operators import journal, responses
from siftline.plans import enrichment
from siftline.sources import versions


class Folder:
    def __init__(self, spark: SparkSession, out: str) -> None:
        self.spark, self.out = spark, out.rstrip("/")
        self.journal, self.commits = f"{self.out}/journal", f"{self.out}/commits"

    def records(self) -> DataFrame | None:
        """All records of the journals of whole runs, or none if there are no journals."""
        whole = [r for r in versions.folders(self.spark, self.journal) if versions.exists(self.spark, f"{self.journal}/{r}/_SUCCESS")]
        return journal.read(self.spark, self.journal) if whole else None

    def committed(self) -> DataFrame:
        """(seq) of the runs whose table is written."""
        return marks(self.spark, self.commits)

    def pending(self) -> list[int]:
        """Runs with a journal but without a mark: their outcomes are known and not yet in the table."""
        done = {r.seq for r in self.committed().collect()}  # a row a run
        return [n for r in versions.folders(self.spark, self.journal) if (n := int(r.removeprefix("run-"))) not in done]

    def recovered(self, table: DataFrame) -> tuple[DataFrame, list[int]]:
        """``table`` after the outcomes of runs that broke off between journal and table, and which runs these are."""
        runs = self.pending()
        if not runs or (records := self.records()) is None:
            return table, []
        return enrichment.recover(table, records, self.committed()), runs

    def commit(self, runs: list[int]) -> None:
        for run in runs:
            enrichment.commit(self.spark, run).write.mode("overwrite").parquet(f"{self.commits}/run-{run}")

    def start(self, config: enrichment.Config, table: str) -> Run:
        """The last run if it has the same settings and table and broke off before its journal, else a new one."""
        wanted = json.dumps({"table": table, "settings": dataclasses.asdict(config)}, sort_keys=True)
        for name in versions.folders(self.spark, f"{self.out}/runs")[::-1][:1]:
            run = Run(self, int(name.removeprefix("run-")))
            if versions.read_text(self.spark, f"{run.folder}/manifest.json") == wanted and not versions.exists(self.spark, f"{self.journal}/{name}/_SUCCESS"):
                return run
        run = Run(self, time.time_ns() // 1000)
        versions.write_text(self.spark, f"{run.folder}/manifest.json", wanted)
        return run


class Run:
    """One run's steps by name; a step that comes again within a run gets a number."""

    def __init__(self, home: Folder, number: int) -> None:
        self.home, self.spark, self.number = home, home.spark, number
        self.folder = f"{home.out}/runs/run-{number}"
        self.seen: Counter[str] = Counter()

    def keep(self, df: DataFrame, step: str) -> DataFrame:
        """``df`` written under ``step`` and read back, or what an earlier attempt wrote there whole."""
        self.seen[step] += 1
        path = f"{self.folder}/{step}-{self.seen[step]}"
        if not versions.exists(self.spark, f"{path}/_SUCCESS"):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def answered(self, requests: DataFrame, make_provider: Callable[[], responses.Provider], **how) -> DataFrame:
        """Answers as ``responses.call`` gives them, each saved by its task as it comes; saved ones are not asked for again."""
        return responses.call_once(requests, make_provider, f"{self.folder}/answers", **how)

    def journaled(self, records: DataFrame) -> DataFrame:
        """The run's records as JSON lines, before its table is built."""
        path = f"{self.home.journal}/run-{self.number}"
        if not versions.exists(self.spark, f"{path}/_SUCCESS"):
            journal.append(records, path, "overwrite")
        return journal.read(self.spark, path)


def marks(spark: SparkSession, folder: str) -> DataFrame:
    """(seq) of all marks in a folder; none if there is no such folder."""
    if not versions.folders(spark, folder):
        return spark.createDataFrame([], "seq long")
    return spark.read.option("recursiveFileLookup", True).schema("seq long").parquet(folder)


def enriched(spark: SparkSession, table: DataFrame, name: str, out: str, provider: Callable[[], responses.Provider], config: enrichment.Config, save: Callable[[DataFrame], str], page_store: DataFrame | None = None, **more) -> tuple[enrichment.Outcome, str, list[int]]:
    """Recover what broke off, run, write the table with ``save``, and mark all of it as done.

    ``name`` tells tables apart. Returns the outcome, where the table is, and the runs that were recovered.
    """
    home = Folder(spark, out)
    table, recovered = home.recovered(table)
    run = home.start(config, name)
    outcome = enrichment.run(table, provider, run.keep, config, page_store, run=run, **more)
    place = save(outcome.sheet)
    home.commit([*recovered, run.number])
    return outcome, place, recovered
