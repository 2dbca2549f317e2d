"""Second pass over companies' own sites: walk, identity, best candidates, and the result that follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions import values as V
from siftline.operators import crawl, identity, pages
from siftline.operators.fetched import Fetched


def enrich(companies: DataFrame, results: DataFrame, page_store: DataFrame | Fetched, max_pages: int = crawl.MAX_PAGES, audit: bool = False, keep=lambda df: df.checkpoint()) -> DataFrame:
    """``results`` with missing e-mails and phones filled from the companies' sites.

    ``companies``: row_index, siret, company_name, address, postal_code, city. ``results``: row_index, the contacts,
    identity_verified, identity_match_type and whatever else. ``page_store``: requested, url (after redirects), html, as a
    table, or as pages that are fetched while the walks go on.
    Results without a website or with both contacts stay as they are. Adds site_pages, deterministic_fields_found,
    legal_popup_detected and, per contact, source and method of what was found.
    """
    open_rows = (F.col("website") != V.MISSING) & ((F.col("email") == V.MISSING) | (F.col("phone") == V.MISSING))
    starts = results.filter(open_rows).select("row_index", V.canonical_url(F.col("website")).alias("start"), (F.col("email") == V.MISSING).alias("needs_email"), (F.col("phone") == V.MISSING).alias("needs_phone"))
    if isinstance(page_store, Fetched):
        read = crawl.crawl(starts, page_store.facts, max_pages, keep)
        parsed = page_store.parsed().join(read.select("requested").distinct(), "requested", "left_semi")
    else:
        parsed = keep(pages.parse(asked_pages(page_store, starts)))
        read = crawl.crawl(starts, crawl.page_facts(parsed), max_pages, keep)
    known = identity.company_keys(companies.select("row_index", "siret", "company_name", "address", "postal_code", "city")).drop("siret", "company_name", "address", "postal_code", "city")
    claims = results.select("row_index", "website", "identity_verified", "email", "phone")
    seen = read.join(parsed, "requested").join(known, "row_index").join(claims, "row_index")
    seen = keep(identity.page_identity(seen).select(*[c for c in seen.columns if c not in ("links", "text", "text_key", "identifiers")], "match_type", "name_matches", "location_matches", "conflicting"))
    verified = identity.site_verified(seen, ["row_index"])
    facts = ["row_index", "page_no", "url", "website", "identity_verified", "name_key", "city_key", "postal_code_key", "match_type", "name_matches", "conflicting"]
    rows = pages.candidates(seen.select(*facts, "candidates"), facts).join(verified, "row_index").filter(identity.is_eligible())
    rows = rows.filter((F.col("field") == "phone") | ~identity.is_platform_email()).withColumn("score", identity.score())
    top = identity.best(rows, ["row_index"])
    of = {f: top.filter(F.col("field") == f).select("row_index", F.col("value").alias(f"_{f}"), F.col("url").alias(f"_{f}_url"), F.col("method").alias(f"_{f}_method")) for f in ("email", "phone")}
    exact = F.when((F.col("match_type") == "siret") & ~F.col("conflicting"), F.col("page_no"))
    sites = seen.groupBy("row_index").agg(F.min_by("url", exact).alias("_exact_url"), F.transform(F.array_sort(F.collect_list(F.struct("page_no", "url"))), lambda x: x["url"]).alias("_pages"), F.max("legal_popup").alias("_popup"))
    out = results.join(sites, "row_index", "left").join(of["email"], "row_index", "left").join(of["phone"], "row_index", "left")
    fills = {f: (F.col(f) == V.MISSING) & F.col(f"_{f}").isNotNull() for f in ("email", "phone")}
    made = {f: F.when(fills[f], F.col(f"_{f}")).otherwise(F.col(f)) for f in fills}
    for f in fills:
        for name, new, default in ((f"{f}_source", F.col(f"_{f}_url"), V.MISSING), (f"{f}_extraction_method", F.col(f"_{f}_method"), "")):
            made[name] = F.when(fills[f], new).otherwise(F.col(name) if name in results.columns else F.lit(default))
    proven = F.col("_exact_url").isNotNull()
    old = lambda c, default: F.col(c) if c in results.columns else F.lit(default)
    made |= {
        "identity_verified": proven | F.col("identity_verified"),
        "identity_match_type": F.when(proven, "siret").otherwise(F.col("identity_match_type")),
        "identity_source": F.when(proven, F.col("_exact_url")).otherwise(old("identity_source", V.MISSING)),
        "identity_extraction_method": F.when(proven, "site_siret_or_siren").otherwise(old("identity_extraction_method", "")),
        "deterministic_pages": F.slice(F.array_distinct(F.coalesce("_pages", F.array().cast("array<string>"))), 1, 12),
        "deterministic_fields_found": F.coalesce(fills["email"], F.lit(False)).cast("int") + F.coalesce(fills["phone"], F.lit(False)).cast("int"),
        "legal_popup_detected": F.coalesce("_popup", F.lit(False)),
    }
    if audit:
        made["sources"] = V.union_distinct(F.col("_pages"), old("sources", None))  # the site's own pages come first
    keepers = [c for c in results.columns if c not in made]
    return out.select(*keepers, *[x.alias(c) for c, x in made.items()])


def asked_pages(page_store: DataFrame, starts: DataFrame) -> DataFrame:
    """The pages that walks can reach, which stay on one host: of the hosts they start at or are sent to from there."""
    first = starts.select(F.col("start").alias("requested")).distinct()
    moved = page_store.join(first, "requested").select(V.url_host(F.col("url")).alias("_host"))
    hosts = starts.select(V.url_host(F.col("start")).alias("_host")).union(moved).distinct()
    return page_store.withColumn("_host", V.url_host(F.col("requested"))).join(hosts, "_host", "left_semi").drop("_host")
