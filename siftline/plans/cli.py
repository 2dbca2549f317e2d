"""Command line: enrich a table, recover one from a journal, list and restore versions, or evaluate models and sites.

python -m siftline.plans.cli enrich companies.csv out --provider package.module:factory
python -m siftline.plans.cli enrich companies.xlsx out --provider package.module:factory --workbook companies.xlsx
python -m siftline.plans.cli recover companies.csv out/journal out
python -m siftline.plans.cli versions out --restore v20260101T000000000000-0a1b2c3d
python -m siftline.plans.cli evaluate-models companies.csv out --provider package.module:factory --deployment a --deployment b
python -m siftline.plans.cli evaluate-sites companies.csv out --page-store pages
"""

from __future__ import annotations

import argparse
import dataclasses
import importlib
import logging
import logging.handlers
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from siftline.operators import evaluate, fetched, journal
from siftline.plans import enrichment, evaluation, runs
from siftline.sources import headers, sheets, versions, web, workbooks

log = logging.getLogger("siftline")


def set_up_logging(level: str, path: str | None = None) -> None:
    """Console and, if named, a rotating file; a second call adds nothing."""
    if not log.handlers:
        log.addHandler(logging.StreamHandler())
        if path:
            log.addHandler(logging.handlers.RotatingFileHandler(path, maxBytes=5 << 20, backupCount=3, encoding="utf-8"))
    log.setLevel(level)


@dataclasses.dataclass(frozen=True)
class Table:
    """A company table under its logical names, and how its own columns were named and bound."""

    rows: DataFrame
    names: list[str]
    binding: headers.Binding

    def restored(self, rows: DataFrame, audit: bool) -> DataFrame:
        return headers.restored(rows, self.names, self.binding, audit)


def read(spark: SparkSession, path: str, sheet: str | None) -> Table:
    """A company table by its file's ending; a folder of versions is read at its pointer."""
    if path.endswith(".xlsx"):
        df = sheets.read_xlsx(spark, path, sheet)
    elif path.endswith((".json", ".jsonl")):
        df = sheets.read_json(spark, path)
    elif path.endswith(".csv"):
        df = sheets.read_csv(spark, path)
    else:
        at = versions.current(spark, path)
        df = sheets.read_parquet(spark, f"{path.rstrip('/')}/{at}" if at else path)
    names = [c for c in df.columns if c != "row_index"]
    binding = headers.bind(names)
    return Table(headers.bound(sheets.text_columns(df), binding), names, binding)


def save_workbook(spark: SparkSession, source: str, target: str, sheet: str | None, table: Table, rows: DataFrame, audit: bool) -> None:
    """The source's workbook with the output fields of ``rows``, and with titles where it had none, at ``target``."""
    cells, titles = headers.output_cells(rows, len(table.names), table.binding, audit)
    if titles:
        first = spark.createDataFrame([(1, titles, [])], cells.schema)
        cells = cells.unionByName(first)
    workbooks.write_workbook(source, target, cells, sheet)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siftline")
    p.add_argument("--log-level", default="INFO")
    p.add_argument("--log-file")
    commands = p.add_subparsers(dest="command", required=True)
    e = commands.add_parser("enrich")
    e.add_argument("table")
    e.add_argument("out")
    e.add_argument("--provider", required=True, help="module:function that makes a provider")
    e.add_argument("--sheet")
    e.add_argument("--page-store", help="Parquet of requested, url, html")
    e.add_argument("--fetch", action="store_true", help="fetch the pages that walks of sites ask for and the page store lacks")
    e.add_argument("--fetcher", help="module:function that makes a function from an address to (final address, html) or none")
    e.add_argument("--ca-file", help="certificates to trust besides the machine's, where all executors find them")
    e.add_argument("--workbook", help="also write the table's workbook here, with only its output cells set; may be the table itself")
    for name, kind in (("start-row", int), ("max-rows", int), ("concurrency", int), ("tries", int), ("wait-s", float), ("calls-per-second", float), ("site-pages", int), ("context-size", str), ("model", str)):
        e.add_argument(f"--{name}", type=kind)
    e.add_argument("--overwrite-existing", action="store_const", const=True)
    e.add_argument("--audit", action="store_const", const=True)
    r = commands.add_parser("recover")
    r.add_argument("table")
    r.add_argument("journal")
    r.add_argument("out")
    r.add_argument("--sheet")
    r.add_argument("--commits", help="marks of runs whose table is written, whose records are left out; by default those beside the journal")
    v = commands.add_parser("versions")
    v.add_argument("table")
    v.add_argument("--restore", metavar="VERSION")
    v.add_argument("--keep", type=int, help="remove all but the current version and this many others")
    m = commands.add_parser("evaluate-models")
    m.add_argument("--provider", required=True, help="module:function that makes a provider for a deployment's name")
    m.add_argument("--deployment", action="append", required=True)
    m.add_argument("--page-store")
    m.add_argument("--max-rows", type=int, default=20)
    m.add_argument("--context-size")
    m.add_argument("--no-audit", action="store_true")
    w = commands.add_parser("evaluate-sites")
    w.add_argument("--page-store", required=True)
    w.add_argument("--max-rows", type=int, default=30)
    for command in (m, w):
        command.add_argument("table")
        command.add_argument("out")
        command.add_argument("--sheet")
        command.add_argument("--start-row", type=int)
    return p


class _Client:
    """A fetcher that makes its client where it runs, once a task."""

    def __init__(self, ca_file: str | None) -> None:
        self.ca_file, self.get = ca_file, None

    def __call__(self, url: str) -> tuple[str, str] | None:
        if self.get is None:
            self.get = web.client(self.ca_file)
        return self.get(url)


def _named(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    set_up_logging(a.log_level, a.log_file)
    spark = spark or SparkSession.builder.appName("siftline").getOrCreate()
    if a.command == "versions":
        return _versions(spark, a)
    opened = read(spark, a.table, a.sheet)
    table = opened.rows
    if a.command == "recover":
        return _recover(spark, a, opened)

    def keep(df: DataFrame, step: str) -> DataFrame:
        path = f"{a.out.rstrip('/')}/steps/{step}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    store = spark.read.parquet(a.page_store) if a.page_store else None
    if a.command == "evaluate-models":
        make = _named(a.provider)
        config = enrichment.Config(audit=not a.no_audit).overridden(start_row=a.start_row, context_size=a.context_size)
        report = evaluation.models(table, a.deployment, lambda name: lambda: make(name), keep, config, a.max_rows, store)
    elif a.command == "evaluate-sites":
        report = evaluation.sites(table, store, keep, enrichment.Config().overridden(start_row=a.start_row), a.max_rows)
    if a.command.startswith("evaluate"):
        log.info("wrote %s", evaluate.write_report(*report, a.out, a.command, a.table))
        return 0
    settings = ("start_row", "max_rows", "concurrency", "tries", "wait_s", "calls_per_second", "site_pages", "context_size", "model", "overwrite_existing", "audit")
    config = enrichment.Config.from_environment(os.environ).overridden(**{n: getattr(a, n) for n in settings})
    place = lambda rows: versions.write(opened.restored(rows, config.audit), a.out)
    if a.fetch:
        ca_file = a.ca_file
        store = fetched.Fetched(spark, f"{a.out.rstrip('/')}/pages", store, _named(a.fetcher)() if a.fetcher else _Client(ca_file), config.concurrency, config.host_gap_s)
    outcome, path, recovered = runs.enriched(spark, table, f"{versions.qualified(spark, a.table)}#{a.sheet or ''}", a.out, _named(a.provider), config, place, store)
    if recovered:
        log.info("recovered runs %s", recovered)
    if a.workbook:
        save_workbook(spark, a.table, a.workbook, a.sheet, opened, outcome.sheet, config.audit)
    log.info("wrote %s", path)
    log.info("counts: %s", outcome.counters.first().asDict())
    return 0


def _recover(spark: SparkSession, a: argparse.Namespace, opened: Table) -> int:
    """Replay what ``enrich`` or ``journal.append`` wrote; a journal without records is an error."""
    records = journal.read(spark, a.journal)
    if records.isEmpty():
        raise journal.JournalError(f"{a.journal} holds no records")
    marks = runs.marks(spark, a.commits or f"{a.journal.rstrip('/').rpartition('/')[0]}/commits")
    left = records.join(marks, "seq", "left_anti").select("seq").distinct().collect()  # a row a run
    done = enrichment.recover(opened.rows, records, marks)
    log.info("replayed runs %s; wrote %s", sorted(r.seq for r in left), versions.write(opened.restored(done, True), a.out))
    return 0


def _versions(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.restore:
        versions.restore(spark, a.table, a.restore)
    if a.keep is not None:
        log.info("removed %s", versions.expire(spark, a.table, a.keep))
    now = versions.current(spark, a.table)
    for v in versions.versions(spark, a.table):
        log.info("%s %s", "*" if v == now else " ", v)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
