"""Results into company tables: repair of results, merging without losing data, and the status that follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions import values as V
from siftline.operators.eligibility import any_contact

SOURCES = {"email": "email_source", "phone": "phone_source", "website": "website_source"}
METHODS = {"email": "email_extraction_method", "phone": "phone_extraction_method"}
#: Metadata that each result replaces.
METADATA = (
    "identity_source", "identity_match_type", "searched_at_utc", "model_deployment", "model_snapshot", "response_id", "input_tokens", "output_tokens", "total_tokens",
    "web_search_calls", "deterministic_pages", "deterministic_fields_found", "email_extraction_method", "phone_extraction_method", "identity_extraction_method", "legal_popup_detected",
)


def normalized(results: DataFrame) -> DataFrame:
    """Contacts and evidence of results in their normal form; source lists valid, distinct and bounded."""
    forms = {"email": V.email, "phone": V.phone, "website": V.website} | dict.fromkeys((*SOURCES.values(), "identity_source"), V.website)
    out = results.withColumns({c: f(F.col(c)) for c, f in forms.items() if c in results.columns})
    return out.withColumns({c: V.url_list(F.col(c), n) for c, n in (("sources", 30), ("deterministic_pages", 12)) if c in results.columns})


def identity_gate(results: DataFrame) -> DataFrame:
    """Without a verified identity no contact stands; without a contact neither its source nor its method does."""
    has = set(results.columns)
    verified = F.coalesce(F.col("identity_verified"), F.lit(False)) & (F.coalesce(F.col("identity_match_type"), F.lit("none")) != "none")
    wiped = {c: F.when(F.col("_ok"), F.col(c)).otherwise(F.lit(V.MISSING)) for c in (*V.CONTACTS, *SOURCES.values()) if c in has}
    wiped |= {c: F.when(F.col("_ok"), F.col(c)).otherwise(F.lit("")) for c in METHODS.values() if c in has}
    wiped |= {"identity_verified": F.col("_ok"), "identity_match_type": F.when(F.col("_ok"), F.col("identity_match_type")).otherwise("none")}
    out = results.withColumn("_ok", verified).withColumns(wiped).drop("_ok")
    lone = {s: F.when(F.col(c) == V.MISSING, F.lit(V.MISSING)).otherwise(F.col(s)) for c, s in SOURCES.items() if s in has}
    lone |= {m: F.when(F.col(c) == V.MISSING, F.lit("")).otherwise(F.col(m)) for c, m in METHODS.items() if m in has}
    if "website_type" in has:
        kind = F.coalesce(F.col("website_type"), F.lit("not_found"))
        lone["website_type"] = F.when(F.col("website") == V.MISSING, "not_found").when(kind == "not_found", "unknown").otherwise(kind)
    return out.withColumns(lone)


def sanitized(results: DataFrame) -> DataFrame:
    return identity_gate(normalized(results))


def is_not_found(results: DataFrame) -> Column:
    return (F.col("email") == V.MISSING) & (F.col("phone") == V.MISSING) & (F.col("website") == V.MISSING)


def takes_value(existing: Column, overwrite: Column) -> Column:
    """Whether a result's value is written: into blank and missing cells, or anywhere when overwriting."""
    text = V.clean(existing)
    return overwrite | text.isNull() | (text == V.MISSING)


def merged_value(existing: Column, new: Column, overwrite: Column) -> Column:
    return F.when(takes_value(existing, overwrite), new).otherwise(existing)


def merged_source(field: str, existing: Column, new: Column, existing_source: Column, new_source: Column, overwrite: Column) -> Column:
    """A source goes in with the value it proves, or with one that matches; it doesn't replace another."""
    relevant = takes_value(existing, overwrite) | V.same_contact(field, V.clean(existing), new)
    free = overwrite | V.clean(existing_source).isNull()
    return F.when(relevant & free, F.nullif(new_source, F.lit(V.MISSING))).otherwise(existing_source)


def merged_website_type(existing: Column, new: Column, existing_type: Column, new_type: Column, overwrite: Column) -> Column:
    matches = V.same_contact("website", V.clean(existing), new) & V.clean(existing_type).isNull()
    return F.when(takes_value(existing, overwrite) | matches, new_type).otherwise(existing_type)


def merged_sources(existing: Column, new: Column, overwrite: Column) -> Column:
    """Old sources before new ones, each once, at most 30, as a JSON list; nothing if there are none."""
    old = F.when(overwrite, F.array().cast("array<string>")).otherwise(V.source_list(existing))
    both = V.union_distinct(old, new)
    return F.when((F.size(both) > 0) | overwrite, F.when(F.size(both) > 0, F.to_json(both))).otherwise(existing)


def result_status(sheet_has_contact: Column, found: Column, overwrite: Column) -> Column:
    """Seen before the merge: success if a contact survives or was found."""
    return F.when((~overwrite & sheet_has_contact) | found, V.SUCCESS).otherwise(V.NOT_FOUND)


def merge(sheet: DataFrame, results: DataFrame, overwrite_existing: bool = False, audit: bool = False) -> DataFrame:
    """``sheet`` with ``results`` merged in by ``row_index``; rows without a result are as before.

    A result may bring a ``status`` of its own (an error): that sets the status and touches no contact.
    """
    over = F.lit(overwrite_existing)
    columns = results.columns
    r = results.select(F.col("row_index").alias("_row"), *[F.col(c).alias(f"r_{c}") for c in columns if c != "row_index"])
    both = sheet.join(r, F.col("row_index") == F.col("_row"), "left")
    failed = F.col("r_status").isin(V.TECHNICAL_ERROR, V.INVALID_INPUT) if "status" in columns else F.lit(False)
    arrived = F.col("_row").isNotNull() & ~F.coalesce(failed, F.lit(False))
    new = {c: merged_value(F.col(c), F.col(f"r_{c}"), over) for c in V.CONTACTS}
    found = V.any_of(*[F.col(f"r_{c}") != V.MISSING for c in V.CONTACTS])
    if "website_type" in columns:
        new["website_type"] = merged_website_type(F.col("website"), F.col("r_website"), F.col("website_type"), F.col("r_website_type"), over)
    if audit:
        new |= {s: merged_source(c, F.col(c), F.col(f"r_{c}"), F.col(s), F.col(f"r_{s}"), over) for c, s in SOURCES.items() if s in columns}
        if "sources" in columns:
            new["sources"] = merged_sources(F.col("sources"), F.col("r_sources"), over)
        for m in METADATA:
            if m in columns:
                text = F.to_json(f"r_{m}") if results.schema[m].dataType.typeName() == "array" else F.col(f"r_{m}").cast("string")
                new[m] = F.when(text.isin("", V.MISSING), None).otherwise(text)
    status = F.when(F.col("_row").isNull(), F.col("status")).when(arrived, result_status(any_contact(*map(F.col, V.CONTACTS)), found, over))
    status = status.otherwise(F.col("r_status")) if "status" in columns else status
    changed = {c: F.when(arrived, x).otherwise(F.col(c)) for c, x in new.items()} | {"status": status}
    return both.select(*[changed.get(c, F.col(c)).alias(c) for c in sheet.columns])
