"""Binding of loosely named columns to the logical fields, by ordered aliases."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions.search_text import search_key_of

# Header aliases of each logical field, most wanted first.
INPUT_ALIASES = {
    "siret": ("siret", "numero siret", "no siret", "n siret", "siret etablissement"),
    "company_name": ("raison sociale", "denomination sociale", "denomination", "nom entreprise officiel", "nom entreprise", "nom de l entreprise", "nom entreprise input", "entreprise"),
    "address": ("adresse officielle", "adresse", "adresse postale", "adresse etablissement", "adresse input"),
    "postal_code": ("code postal", "codepostal", "cp"),
    "city": ("ville", "commune", "localite"),
}
OUTPUT_ALIASES = {
    "email": ("email", "e mail", "mail", "adresse email", "email societe"),
    "phone": ("telephone", "tel", "numero telephone"),
    "website": ("site web", "site internet", "website", "url site web"),
    "website_type": ("site web type", "website type", "type site web", "nature site web"),
    "status": ("enrichment status", "statut enrichissement"),
    "sources": ("enrichment sources", "sources enrichissement"),
    "email_source": ("email source", "source email"),
    "phone_source": ("telephone source", "source telephone"),
    "website_source": ("site web source", "source site web"),
    "identity_source": ("identity source", "source identite"),
    "identity_match_type": ("identity match type", "type rapprochement identite"),
    "searched_at_utc": ("search timestamp utc", "horodatage recherche utc"),
    "model_deployment": ("model deployment", "deploiement modele"),
    "model_snapshot": ("model snapshot", "snapshot modele"),
    "response_id": ("azure response id", "identifiant reponse azure"),
    "input_tokens": ("input tokens", "tokens entree"),
    "output_tokens": ("output tokens", "tokens sortie"),
    "total_tokens": ("total tokens", "tokens total"),
    "web_search_calls": ("web search calls", "appels recherche web"),
    "deterministic_pages": ("deterministic pages", "pages deterministes"),
    "deterministic_fields_found": ("deterministic fields found", "champs deterministes trouves"),
    "email_extraction_method": ("email extraction method", "methode extraction email"),
    "phone_extraction_method": ("telephone extraction method", "methode extraction telephone"),
    "identity_extraction_method": ("identity extraction method", "methode extraction identite"),
    "legal_popup_detected": ("legal popup detected", "popup mentions legales detecte"),
}
# The titles under which fields are written where a sheet has none.
TITLES = {
    "siret": "SIRET", "company_name": "Raison sociale", "address": "Adresse", "postal_code": "Code postal", "city": "Ville",
    "email": "Email", "phone": "Telephone", "website": "Site Web", "website_type": "Site Web Type", "status": "Enrichment Status",
    "sources": "Enrichment Sources", "email_source": "Email Source", "phone_source": "Telephone Source", "website_source": "Site Web Source",
    "identity_source": "Identity Source", "identity_match_type": "Identity Match Type", "searched_at_utc": "Search Timestamp UTC",
    "model_deployment": "Model Deployment", "model_snapshot": "Model Snapshot", "response_id": "Azure Response ID", "input_tokens": "Input Tokens",
    "output_tokens": "Output Tokens", "total_tokens": "Total Tokens", "web_search_calls": "Web Search Calls", "deterministic_pages": "Deterministic Pages",
    "deterministic_fields_found": "Deterministic Fields Found", "email_extraction_method": "Email Extraction Method",
    "phone_extraction_method": "Telephone Extraction Method", "identity_extraction_method": "Identity Extraction Method", "legal_popup_detected": "Legal Popup Detected",
}
REQUIRED = ("siret", "company_name")
# 1-based positions of the historical layout, for sheets without headers.
LEGACY_POSITIONS = {"siret": 3, "company_name": 4, "address": 7, "postal_code": 8, "city": 9, "email": 16, "phone": 17, "website": 18, "status": 26, "sources": 27, "website_type": 47}


class HeaderError(ValueError):
    """A required field has no column, or an alias names several."""


@dataclass(frozen=True)
class Binding:
    """Logical field to the position of its column (from 0); fields to be appended have none."""

    found: dict[str, int]
    appended: tuple[str, ...]


def bind(headers: list[str]) -> Binding:
    """The first alias that occurs wins; it must occur once. Output fields without a column are appended in order."""
    places = defaultdict(list)
    for i, h in enumerate(headers):
        places[search_key_of(h)].append(i)
    found: dict[str, int] = {}
    for field, aliases in {**INPUT_ALIASES, **OUTPUT_ALIASES}.items():
        hit = next((a for a in aliases if places.get(a)), None)
        if hit is not None:
            if len(places[hit]) > 1:
                raise HeaderError(f"{field}: several columns are named {hit!r}")
            found[field] = places[hit][0]
    if lost := [f for f in REQUIRED if f not in found]:
        raise HeaderError(f"no column for {', '.join(lost)}; headers: {', '.join(h for h in headers if h) or 'none'}")
    return Binding(found, tuple(f for f in OUTPUT_ALIASES if f not in found))


OTHER = "other column "
#: Fields that are written as numbers where a sheet has numbers.
NUMERIC = ("input_tokens", "output_tokens", "total_tokens", "web_search_calls", "deterministic_fields_found")
#: Fields that are written without an audit as well.
ALWAYS = ("email", "phone", "website", "website_type", "status")


def bound(df: DataFrame, binding: Binding | None = None) -> DataFrame:
    """``df`` with its columns under their logical names and missing output fields as null strings.

    Columns that no field takes follow under ``other column <position>``, so that ``restored`` can put them back.
    """
    names = [c for c in df.columns if c != "row_index"]
    binding = binding or bind(names)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = [df.columns.index("row_index")] if "row_index" in df.columns else []
    places = [i for i in range(len(df.columns)) if i not in at[:1]]
    fields = [F.col(f"c{places[binding.found[f]]}").alias(f) if f in binding.found else F.lit(None).cast("string").alias(f) for f in (*INPUT_ALIASES, *OUTPUT_ALIASES)]
    others = [F.col(f"c{i}").alias(f"{OTHER}{n}") for n, i in enumerate(places) if n not in binding.found.values()]
    return plain.select(*[F.col(f"c{i}").alias("row_index") for i in at[:1]], *fields, *others)


def restored(df: DataFrame, names: list[str], binding: Binding, audit: bool = True) -> DataFrame:
    """A bound table under the headers it came with, in their order; appended fields follow under their titles."""
    field_at = {place: f for f, place in binding.found.items()}
    own = [F.col(field_at[i] if i in field_at else f"{OTHER}{i}").alias(f"c{i}") for i in range(len(names))]
    added = [f for f in binding.appended if audit or f in ALWAYS]
    row = ["row_index"] if "row_index" in df.columns else []
    return df.select(*row, *own, *[F.col(f).alias(f"a{i}") for i, f in enumerate(added)]).toDF(*row, *names, *[TITLES[f] for f in added])


def output_cells(df: DataFrame, width: int, binding: Binding, audit: bool = True) -> tuple[DataFrame, dict[int, str]]:
    """(cells, titles) for a workbook of ``width`` columns: per row the values of the output fields that hold any, by
    column from 0, and the titles of the header cells that the sheet lacks."""
    fields = [f for f in OUTPUT_ALIASES if audit or f in ALWAYS]
    added = [f for f in binding.appended if f in fields]
    place = {f: binding.found[f] if f in binding.found else width + added.index(f) for f in fields}
    entries = F.array(*[F.struct(F.lit(place[f]).alias("key"), F.col(f).alias("value")) for f in fields])
    values = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    numeric = F.array(*[F.lit(place[f]) for f in fields if f in NUMERIC]).cast("array<int>")
    return df.select("row_index", values.alias("values"), numeric.alias("numeric")).filter(F.size("values") > 0), {place[f]: TITLES[f] for f in added}


def titled(df: DataFrame) -> DataFrame:
    """Logical names back to titles, for export."""
    return df.withColumnsRenamed({f: t for f, t in TITLES.items() if f in df.columns})
