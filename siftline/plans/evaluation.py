"""Evaluations: models against rows that are done, and the pass over companies' own sites against known contacts."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.operators import enrich, evaluate, responses
from siftline.plans.enrichment import Config, looked_up

Keep = Callable[[DataFrame, str], DataFrame]


def models(sheet: DataFrame, deployments: list[str], provider_of: Callable[[str], Callable[[], responses.Provider]], keep: Keep, config: Config | None = None, max_rows: int = 20, page_store: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, summary): every reference row looked up by every deployment. The list of deployments is the caller's."""
    c = (config or Config(audit=True)).checked()
    references = keep(evaluate.model_references(sheet.filter(F.col("row_index") >= c.start_row), max_rows), "references")
    companies = keep(sheet.join(references.select("row_index"), "row_index", "left_semi"), "companies")
    crossed = evaluate.cross_deployments(references, deployments)
    found = []
    for name in dict.fromkeys(d.strip() for d in deployments):
        _, fine, failed = looked_up(companies, provider_of(name), keep, replace(c, model=name), page_store)
        found.append(fine.unionByName(failed.drop("status"), True).withColumn("deployment", F.lit(name)))
    results = reduce(lambda a, b: a.unionByName(b, True), found)
    rows = keep(evaluate.model_rows(crossed, results, c.context_size, c.audit, c.read_sites and page_store is not None), "evaluation")
    return rows, evaluate.model_summary(rows)


def sites(sheet: DataFrame, page_store: DataFrame, keep: Keep, config: Config | None = None, max_rows: int = 30) -> tuple[DataFrame, DataFrame]:
    """(rows, summary): what companies' own sites add to rows that lack a contact. All sites are read in one plan, so a
    row's latency is its share of the whole."""
    c = (config or Config()).checked()
    references = keep(evaluate.site_references(sheet.filter(F.col("row_index") >= c.start_row), max_rows), "references")
    began = time.perf_counter()
    company = ("siret", "company_name", "address", "postal_code", "city", "status")
    done = keep(enrich.enrich(references, references.drop(*company), page_store, c.site_pages, True, lambda df: keep(df, "walk")), "site-results")
    each = (time.perf_counter() - began) / max(1, done.count())
    rows = keep(evaluate.site_rows(references, done, each), "site-evaluation")
    return rows, evaluate.site_summary(rows.withColumn("pages_fetched", F.size(F.from_json("deterministic_pages", "array<string>"))))
