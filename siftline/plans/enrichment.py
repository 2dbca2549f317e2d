"""A whole enrichment run as one plan of written steps: eligible rows, answers, results, merged table, counters."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, fields, replace
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions import values as V
from siftline.operators import eligibility, enrich, journal, merge, responses

if TYPE_CHECKING:
    from siftline.plans import runs


@dataclass(frozen=True)
class Config:
    """Settings of a run; ``checked`` refuses those that make no sense."""

    start_row: int = 2
    max_rows: int | None = None
    skip_if_filled: bool = True
    overwrite_existing: bool = False
    audit: bool = False
    site_pages: int = 6
    read_sites: bool = True
    concurrency: int = 4
    tries: int = 3
    wait_s: float = 5.0
    calls_per_second: float | None = None
    host_gap_s: float = 1.0
    model: str = "recorded"
    context_size: str = "default"
    effort: str = "low"
    instructions: str = "Find the public contacts of this company. Answer with the agreed JSON only."
    template: str = "SIRET: {siret}\nName: {company_name}\nAddress: {address}\nPostal code: {postal_code}\nCity: {city}"
    unknown: dict[str, str] = field(default_factory=lambda: {"address": "unknown", "postal_code": "unknown", "city": "unknown"})

    @classmethod
    def from_environment(cls, env: Mapping[str, str], prefix: str = "SIFTLINE_") -> Config:
        """Settings from variables such as SIFTLINE_MAX_ROWS; blank ones count as not given, a 0 is kept, others must fit."""
        given = {f.name: V.setting(env.get(f"{prefix}{f.name.upper()}"), str(f.type), f.default) for f in fields(cls) if f.name != "unknown"}
        return cls(**given).checked()

    def checked(self) -> Config:
        bad = [n for n, ok in (("start_row", self.start_row >= 2), ("site_pages", 1 <= self.site_pages <= 12), ("concurrency", 1 <= self.concurrency <= 32), ("tries", self.tries > 0), ("wait_s", self.wait_s >= 0), ("host_gap_s", self.host_gap_s >= 0), ("calls_per_second", self.calls_per_second is None or self.calls_per_second > 0), ("context_size", self.context_size in ("default", "low", "medium", "high")), ("effort", self.effort in ("none", "minimal", "low", "medium", "high"))) if not ok]
        if bad:
            raise ValueError(f"out of range: {', '.join(bad)}")
        return self

    def overridden(self, **changes) -> Config:
        """With the settings that are given (None: not given), checked."""
        return replace(self, **{k: v for k, v in changes.items() if v is not None}).checked()


@dataclass(frozen=True)
class Outcome:
    sheet: DataFrame
    results: DataFrame
    journal: DataFrame
    counters: DataFrame
    run: int


def run(sheet: DataFrame, provider: Callable[[], responses.Provider], keep: Callable[[DataFrame, str], DataFrame], config: Config | None = None, page_store: DataFrame | None = None, run: runs.Run | None = None) -> Outcome:
    """Enrich ``sheet`` (logical columns and row_index, and any others). ``keep`` writes a step and reads it back.

    The raw answers are kept before anything is derived from them. The journal is kept before the merged table is
    built, so that a run that breaks off between the two can be replayed. With ``run`` answers are saved as they come, the
    journal is one of JSON lines, and the records carry the run's number.
    """
    c = (config or Config()).checked()
    began = run.number if run else time.time_ns() // 1000  # orders this run's records after those of earlier runs; a row has one record a run
    sheet = keep(sheet, "sheet")
    rows = eligibility.row_range(sheet, c.start_row, c.max_rows)
    todo = keep(rows.filter(~eligibility.skip(c.overwrite_existing, c.skip_if_filled)), "eligible")
    usable = eligibility.is_processable(F.col("siret"), F.col("company_name"))
    raw, fine, failed = looked_up(todo.filter(usable), provider, keep, c, page_store, run.answered if run else responses.call)
    invalid = todo.filter(~usable).select("row_index", F.lit("InvalidInput").alias("error_type"), F.lit("").alias("error_message"), F.lit(V.INVALID_INPUT).alias("status"))
    everything = keep(fine.withColumn("status", F.lit(None).cast("string")).unionByName(failed, True).unionByName(invalid, True), "outcomes")
    lines = everything.join(todo.select("row_index", "siret", "company_name"), "row_index")
    value = F.struct(*[F.col(x) for x in ("email", "phone", "website", "website_type", "sources", "email_source", "phone_source", "website_source")])
    written = lines.select(
        F.lit(began).cast("long").alias("seq"), F.lit(1).alias("version"), F.current_timestamp().alias("recorded_at_utc"), "row_index", "siret", "company_name",
        F.when(F.col("status").isNull(), value).alias("result"),
        F.coalesce("status", F.when(merge.is_not_found(lines), V.NOT_FOUND).otherwise(V.SUCCESS)).alias("status"), F.lit(c.overwrite_existing).alias("overwrite_existing"), "error_type", "error_message",
    )
    log = run.journaled(written) if run else keep(written, "journal")
    keep(responses.unreadable(raw), "unreadable-answers")
    merged = keep(merge.merge(sheet, everything, c.overwrite_existing, c.audit), "merged")
    touched = merged.join(everything.select("row_index"), "row_index", "left_semi")
    scanned = keep(rows.agg(F.count(F.lit(1)).alias("scanned_rows")), "scanned")
    counters = eligibility.run_counters(touched).withColumn("scanned_rows", scanned.scalar())
    return Outcome(merged, everything, log, counters, began)


def looked_up(companies: DataFrame, provider: Callable[[], responses.Provider], keep: Callable[[DataFrame, str], DataFrame], c: Config, page_store: DataFrame | None, call: Callable[..., DataFrame] = responses.call) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw answers, results after sites, audit and gate, rows whose lookup failed) of usable companies."""
    asked = responses.requests(companies, c.model, c.instructions, c.template, c.unknown, c.context_size, c.audit, effort=c.effort)
    raw = keep(call(asked, provider, tries=c.tries, wait_s=c.wait_s, concurrency=c.concurrency, calls_per_second=c.calls_per_second), "raw-answers")
    results = keep(_results(raw, c.model), "results")
    fine = results.filter("error_type = ''")
    if c.read_sites and page_store is not None:
        fine = enrich.enrich(companies, fine, page_store, c.site_pages, c.audit, lambda df: keep(df, "walk"))
    if c.audit:
        pages = V.union_distinct(F.col("sources"), F.col("deterministic_pages")) if "deterministic_pages" in fine.columns else F.col("sources")
        fine = responses.evidence_policy(fine.withColumn("sources", pages))
    failed = results.filter("error_type <> ''").select("row_index", "error_type", "error_message").withColumn("status", F.lit(V.TECHNICAL_ERROR))
    return raw, merge.identity_gate(fine), failed


def _results(raw: DataFrame, model: str) -> DataFrame:
    """The last answer of each row decoded, with where it comes from and the usage and searches of all its attempts."""
    costs = raw.withColumns({**responses.usage(F.col("raw")), "web_search_calls": responses.search_calls(F.col("raw"))})
    costs = costs.groupBy("row_index").agg(*[F.sum(x).cast("long").alias(x) for x in ("input_tokens", "output_tokens", "total_tokens", "web_search_calls")], F.sum("latency_seconds").alias("latency_seconds"))
    last = raw.groupBy("row_index").agg(F.max_by(F.struct("raw", "error_type", "error_message"), "attempt").alias("r")).select("row_index", "r.*")
    read = responses.decoded(last.withColumn("answer", responses.answer_text(F.col("raw"))))
    read = read.withColumns({"sources": responses.sources(F.col("raw")), **responses.origin(F.col("raw")), "model_deployment": F.lit(model), "searched_at_utc": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")})
    bad = (F.col("error_type") == "") & (F.col("decode_error") != "")
    read = read.withColumns({"error_message": F.when(bad, F.col("decode_error")).otherwise(F.col("error_message")), "error_type": F.when(bad, "UnreadableAnswer").otherwise(F.col("error_type"))})
    return responses.mark_methods(read).drop("raw", "answer", "decode_error").join(costs, "row_index")


def commit(spark: SparkSession, run: int) -> DataFrame:
    """The mark that a run's table is written, so that its records needn't be replayed; the caller writes it after the table."""
    return spark.range(1).select(F.lit(run).cast("long").alias("seq"), F.current_timestamp().alias("committed_at_utc"))


def recover(sheet: DataFrame, records: DataFrame, commits: DataFrame | None = None) -> DataFrame:
    """``sheet`` after the records of runs that broke off, those without a mark in ``commits``; fails as a whole if any
    belongs to another table."""
    if commits is not None:
        records = records.join(commits.select("seq").distinct(), "seq", "left_anti")
    return journal.replay(sheet, journal.from_records(records))
