"""Candidate results against a trusted baseline: rows, and summaries per deployment or over a site extraction."""

from __future__ import annotations

import json
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions import values as V
from siftline.operators.eligibility import is_processable, read_status


def model_references(sheet: DataFrame, max_rows: int) -> DataFrame:
    """The first ``max_rows`` usable rows with a final status, in row order; contacts become the baseline."""
    rows = sheet.filter(read_status(F.col("status")).isin(V.SUCCESS, V.NOT_FOUND) & is_processable(F.col("siret"), F.col("company_name")))
    base = [F.coalesce(V.clean(F.col(c)), F.lit(V.MISSING)).alias(f"baseline_{c}") for c in V.CONTACTS]
    return rows.select("row_index", V.digits(F.col("siret")).alias("siret"), "company_name", read_status(F.col("status")).alias("baseline_status"), *base).orderBy("row_index").limit(max_rows)


def site_references(sheet: DataFrame, max_rows: int) -> DataFrame:
    """The first ``max_rows`` successful rows with a website and without an e-mail or a phone, as trusted results."""
    cell = {c: F.coalesce(V.clean(F.col(c)), F.lit(V.MISSING)) for c in V.CONTACTS}
    wanted = (cell["website"] != V.MISSING) & ((cell["email"] == V.MISSING) | (cell["phone"] == V.MISSING))
    rows = sheet.filter((read_status(F.col("status")) == V.SUCCESS) & is_processable(F.col("siret"), F.col("company_name")) & wanted)
    match = F.col("identity_match_type") if "identity_match_type" in sheet.columns else F.lit(None).cast("string")
    match = F.when(match.isin(*V.MATCH_TYPES) & (match != "none"), match).otherwise("name_and_city")
    own = lambda c: V.clean(F.col(c)) if c in sheet.columns else F.lit(None).cast("string")
    page = F.coalesce(own("website_source"), cell["website"])
    trusted = {"website_source": page, "identity_source": F.coalesce(own("identity_source"), page), "identity_match_type": match, "identity_verified": F.lit(True), "identity_extraction_method": F.lit("baseline")}
    trusted |= {f"{c}_source": F.coalesce(own(f"{c}_source"), F.lit(V.MISSING)) for c in ("email", "phone")}
    trusted |= {f"{c}_extraction_method": F.when(cell[c] != V.MISSING, "baseline").otherwise("") for c in ("email", "phone")}
    trusted |= {"sources": V.source_list(F.col("sources"))} if "sources" in sheet.columns else {}
    return rows.withColumns(cell | trusted).orderBy("row_index").limit(max_rows)


def cross_deployments(references: DataFrame, deployments: list[str]) -> DataFrame:
    """Every reference for every deployment, named once each; a blank name is an error. The list is the caller's."""
    names = list(dict.fromkeys(d.strip() for d in deployments))
    if not all(names):
        raise ValueError("a deployment has no name")
    return references.withColumn("deployment", F.explode(F.array(*map(F.lit, names))))


def compared(rows: DataFrame) -> DataFrame:
    """``<field>_exact_match`` for each contact; errors match nothing."""
    fine = F.coalesce(F.col("error_type"), F.lit("")) == ""
    return rows.withColumns({f"{c}_exact_match": fine & V.contacts_match(c, F.col(f"baseline_{c}"), F.col(f"candidate_{c}")) for c in V.CONTACTS})


def evaluation_rows(references: DataFrame, results: DataFrame) -> DataFrame:
    """References joined to results by deployment and row; a reference without a result is an error row of missing labels."""
    joined = references.join(results, ["deployment", "row_index"], "left").withColumn("error_type", F.coalesce("error_type", F.lit("MissingResult")))
    failed = F.col("error_type") != ""
    cells = {f"candidate_{c}": F.when(failed, V.MISSING).otherwise(F.coalesce(f"candidate_{c}", F.lit(V.MISSING))) for c in V.CONTACTS}
    found = V.any_of(*[F.col(f"candidate_{c}") != V.MISSING for c in V.CONTACTS])
    out = joined.withColumns(cells)
    out = out.withColumn("candidate_status", F.when(failed, V.TECHNICAL_ERROR).when(found, V.SUCCESS).otherwise(V.NOT_FOUND))
    if "error_message" in out.columns:
        out = out.withColumn("error_message", F.substring(F.coalesce("error_message", F.lit("")), 1, 500))
    return compared(out)


#: What a row of an evaluation holds where its lookup failed, by column.
WHERE_FAILED = (
    dict.fromkeys(("identity_source", "email_source", "phone_source", "website_source"), V.MISSING)
    | dict.fromkeys(("sources", "deterministic_pages"), "[]")
    | dict.fromkeys(("input_tokens", "output_tokens", "total_tokens", "web_search_calls", "deterministic_fields_found"), 0)
    | dict.fromkeys(("email_extraction_method", "phone_extraction_method", "identity_extraction_method"), "")
    | {"identity_match_type": "none", "legal_popup_detected": False, "latency_seconds": 0.0}
)
# The columns of the two reports.
MODEL_COLUMNS = (
    "deployment", "search_context_size", "audit_enabled", "site_extraction_enabled", "row_index", "siret", "company_name", "baseline_status", "baseline_email", "baseline_phone", "baseline_website",
    "candidate_status", "candidate_email", "candidate_phone", "candidate_website", "email_exact_match", "phone_exact_match", "website_exact_match", "identity_match_type", "identity_source",
    "email_source", "phone_source", "website_source", "sources", "input_tokens", "output_tokens", "total_tokens", "web_search_calls", "deterministic_pages", "deterministic_fields_found",
    "email_extraction_method", "phone_extraction_method", "identity_extraction_method", "legal_popup_detected", "latency_seconds", "error_type", "error_message",
)
SITE_COLUMNS = (
    "row_index", "siret", "company_name", "website", "baseline_email", "candidate_email", "email_source", "email_extraction_method", "baseline_phone", "candidate_phone", "phone_source",
    "phone_extraction_method", "identity_match_type", "identity_source", "identity_extraction_method", "deterministic_pages", "deterministic_fields_found", "legal_popup_detected",
    "latency_seconds", "error_type", "error_message",
)


def _cells(rows: DataFrame) -> DataFrame:
    """``rows`` with the cells of a report: lists as JSON, seconds to the millisecond, failed rows as ``WHERE_FAILED`` says."""
    cells = {}
    for c, default in WHERE_FAILED.items():
        value = F.lit(default)
        if c in rows.columns:
            own = F.to_json(c) if rows.schema[c].dataType.typeName() == "array" else F.round(c, 3) if c == "latency_seconds" else F.col(c)
            value = F.when(F.col("error_type") != "", default).otherwise(F.coalesce(own, F.lit(default)))
        cells[c] = value
    return rows.withColumns(cells | {"error_message": F.substring(F.coalesce("error_message", F.lit("")), 1, 500)})


def model_rows(references: DataFrame, results: DataFrame, context_size: str, audit: bool, site_extraction: bool) -> DataFrame:
    """The report of a model evaluation, ``MODEL_COLUMNS``: crossed references with their results by deployment and row."""
    named = results.withColumnsRenamed({c: f"candidate_{c}" for c in V.CONTACTS})
    rows = _cells(evaluation_rows(references, named.drop("siret", "company_name")))
    settings = {"search_context_size": F.lit(context_size), "audit_enabled": F.lit(audit), "site_extraction_enabled": F.lit(site_extraction)}
    return rows.withColumns(settings).select(*MODEL_COLUMNS)


def site_rows(references: DataFrame, results: DataFrame, latency_seconds: float) -> DataFrame:
    """The report of a site evaluation, ``SITE_COLUMNS``: trusted rows with what their sites gave; a row without a result
    is an error that keeps its trusted contacts."""
    known = references.select("row_index", V.digits(F.col("siret")).alias("siret"), "company_name", "website", F.col("email").alias("baseline_email"), F.col("phone").alias("baseline_phone"))
    there = results.drop("website", "siret", "company_name", "error_type", "error_message").withColumnsRenamed({"email": "candidate_email", "phone": "candidate_phone"})
    rows = known.join(there.withColumn("error_type", F.lit("")), "row_index", "left").withColumn("error_type", F.coalesce("error_type", F.lit("MissingResult")))
    kept = {f"candidate_{c}": F.coalesce(f"candidate_{c}", f"baseline_{c}") for c in ("email", "phone")}
    return _cells(rows.withColumns(kept | {"latency_seconds": F.lit(float(latency_seconds)), "error_message": F.lit("")})).select(*SITE_COLUMNS)


def percentage(part: Column, whole: Column) -> Column:
    return F.coalesce(F.round(F.try_divide(part * 100, whole), 1), F.lit(0.0))


def model_summary(rows: DataFrame) -> DataFrame:
    """The metrics of each deployment: counts as longs, the match rate in percent and the mean latency as measured.

    One grouping with map-side combining; fields are counted side by side instead of being unpivoted.
    """
    done = F.coalesce(F.col("error_type"), F.lit("")) == ""
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False))).cast("long")
    add = lambda xs: reduce(lambda a, b: a + b, xs)
    base = {c: V.is_found(F.col(f"baseline_{c}")) for c in V.CONTACTS}
    cand = {c: V.is_found(F.col(f"candidate_{c}")) for c in V.CONTACTS}
    total = lambda c: F.coalesce(F.sum(F.when(done, F.col(c))), F.lit(0)).cast("long")
    exact, known = add(n(done & base[c] & F.col(f"{c}_exact_match")) for c in V.CONTACTS), add(n(done & base[c]) for c in V.CONTACTS)
    return rows.groupBy("deployment").agg(
        F.count(F.lit(1)).cast("long").alias("requested_rows"), n(done).alias("completed_rows"), n(~done).alias("error_rows"),
        n(F.col("baseline_status") == V.SUCCESS).alias("baseline_success_rows"), n(done & (F.col("candidate_status") == V.SUCCESS)).alias("candidate_success_rows"),
        known.alias("baseline_found_fields"), add(n(done & cand[c]) for c in V.CONTACTS).alias("candidate_found_fields"), exact.alias("exact_matches"),
        percentage(exact, known).alias("exact_match_pct"), add(n(done & cand[c] & ~base[c]) for c in V.CONTACTS).alias("new_contacts"),
        total("input_tokens").alias("input_tokens"), total("output_tokens").alias("output_tokens"), total("total_tokens").alias("total_tokens"),
        total("web_search_calls").alias("web_search_calls"), total("deterministic_fields_found").alias("deterministic_fields_found"),
        n(done & (F.col("deterministic_fields_found") > 0)).alias("rows_with_gain"), F.coalesce(F.avg(F.when(done, F.col("latency_seconds"))), F.lit(0.0)).alias("average_latency_seconds"),
    )


def site_summary(rows: DataFrame) -> DataFrame:
    """One row of metrics of a site extraction, zeros if there were no rows."""
    done = F.coalesce(F.col("error_type"), F.lit("")) == ""
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False))).cast("long")
    won = lambda c: n(done & (F.col(f"baseline_{c}") == V.MISSING) & (F.col(f"candidate_{c}") != V.MISSING))
    return rows.agg(
        F.count(F.lit(1)).cast("long").alias("requested_rows"), n(done).alias("completed_rows"), n(~done).alias("error_rows"),
        n(done & (F.col("deterministic_fields_found") > 0)).alias("rows_with_gain"), won("email").alias("recovered_emails"), won("phone").alias("recovered_phones"),
        n(done & (F.col("identity_extraction_method") == "site_siret_or_siren")).alias("site_identity_matches"), n(done & F.col("legal_popup_detected")).alias("legal_popups_detected"),
        F.coalesce(F.sum(F.when(done, F.col("pages_fetched"))), F.lit(0)).cast("long").alias("pages_fetched"),
        F.coalesce(F.avg(F.when(done, F.col("latency_seconds"))), F.lit(0.0)).alias("average_latency_seconds"),
    )


def write_report(rows: DataFrame, summary: DataFrame, folder: str, name: str, source: str) -> dict[str, str]:
    """Rows as CSV (none if there are no rows) and the summary with its origin as JSON; returns their paths.

    Reports have a row per evaluated company; the CSV is one file for spreadsheets, written by Spark.
    """
    stem = f"{folder.rstrip('/')}/{name}_{datetime.now(UTC):%Y%m%d_%H%M%S}"
    out = {"json": f"{stem}.summary"}
    if not rows.isEmpty():
        out["csv"] = f"{stem}.rows"
        # spreadsheets know UTF-8 by the mark at the very start, which is that of the first column's name
        marked = rows.withColumnRenamed(rows.columns[0], "\ufeff" + rows.columns[0])
        marked.orderBy(marked["row_index"] if "row_index" in marked.columns else marked[0]).coalesce(1).write.option("header", True).csv(out["csv"])
    entry = summary.withColumns({"created_at_utc": F.lit(datetime.now(UTC).isoformat()), "source": F.lit(source)})
    entry.coalesce(1).write.json(out["json"])
    return out


def as_json(summary: DataFrame) -> str:
    """The summary as JSON text; it has a row per deployment."""
    return json.dumps([r.asDict() for r in summary.collect()], ensure_ascii=False)
