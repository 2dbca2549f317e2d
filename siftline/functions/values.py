"""Cell and contact values as Column expressions: cleaning, normalising, validating. No Python runs on rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a missing contact is written as, and what is read as missing.
MISSING = "Non trouvé"
MISSING_TOKENS = ("", "none", "null", "unknown", "n/a", "na", "not found", "introuvable", "aucun", "aucune", "non disponible", "non renseigne", "non renseigné", "non trouve", "non trouvé")
TRUE_TOKENS = ("1", "true", "yes", "y", "oui", "on")
FALSE_TOKENS = ("0", "false", "no", "n", "non", "off")
SUCCESS, NOT_FOUND, TECHNICAL_ERROR, INVALID_INPUT = STATUSES = ("success", "not_found", "technical_error", "invalid_input")
MATCH_TYPES = ("siret", "name_and_address", "name_and_city", "none")
WEBSITE_TYPES = ("official_site", "google_maps", "directory", "social_network", "marketplace", "other", "unknown", "not_found")
CONTACTS = ("email", "phone", "website")

# Java's \s is ASCII; with (?U) it takes no-break spaces too, and the four separators are added.
_SPACE = "(?U)[\\s\u001c-\u001f]+"
_URL = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def collapse(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.btrim(F.regexp_replace(text.cast("string"), _SPACE, " "))


def clean(text: Column) -> Column:
    """A cell's text, or null if it is blank."""
    return F.nullif(collapse(text), F.lit(""))


def present(value: Column) -> Column:
    """``value`` with white space collapsed, or the missing label for null and the tokens that mean nothing."""
    text = F.coalesce(collapse(value), F.lit(""))
    return F.when(F.lower(text).isin(*MISSING_TOKENS), F.lit(MISSING)).otherwise(text)


def is_found(value: Column) -> Column:
    text = F.coalesce(F.btrim(value), F.lit(""))
    return (text != "") & (F.lower(text) != MISSING.lower())


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def has_valid_siret(siret: Column) -> Column:
    """Fourteen ASCII digits once the rest is taken out; there is no checksum."""
    return F.length(digits(F.coalesce(siret, F.lit("")))) == 14


def zero_padded(value: Column, width: int) -> Column:
    """Zeros in front of shorter values; longer ones stay whole."""
    return F.when(F.length(value) < width, F.lpad(value, width, "0")).otherwise(value)


def cell_text(number: Column, number_format: Column) -> Column:
    """A numeric cell as text: formats made of 0 and # alone pad whole numbers to their count of zeros."""
    plain = F.regexp_replace(F.coalesce(number_format, F.lit("")), '[\\\\" ]', "")
    whole = number == F.floor(number)
    text = F.when(whole, number.cast("decimal(38,0)").cast("string")).otherwise(number.cast("string"))
    zeros = F.length(F.regexp_replace(plain, "[^0]", ""))
    pads = whole & plain.rlike("^[0#]*0[0#]*$") & (F.length(text) < zeros)
    return F.when(pads, F.lpad(text, zeros, F.lit("0"))).otherwise(text)


def boolean(value: Column, default: bool = False) -> Column:
    text = F.lower(F.btrim(value.cast("string")))
    return F.when(text.isin(*TRUE_TOKENS), True).when(text.isin(*FALSE_TOKENS), False).otherwise(F.lit(default))


def setting(text: str | None, kind: str, default: object) -> object:
    """A setting's text as its kind (a type's name, with ``| None`` or without): blank is the default, a 0 is kept, a
    truth value that isn't one is the default, a number that isn't one is an error."""
    text = (text or "").strip()
    if not text:
        return default
    if kind.startswith("bool"):
        return True if text.lower() in TRUE_TOKENS else False if text.lower() in FALSE_TOKENS else default
    return {"int": int, "float": float}.get(kind.partition(" ")[0], str)(text)


def optional_number(value: Column, kind: str) -> Column:
    """Blank is null; anything else must be a number (under ANSI rules a bad one is an error)."""
    return F.nullif(F.btrim(value), F.lit("")).cast(kind)


def email(value: Column) -> Column:
    """A lower-case address, or the missing label."""
    text = present(value)
    text = F.when(F.lower(text).startswith("mailto:"), F.btrim(F.substring(text, 8, 1 << 30))).otherwise(text)
    text = F.lower(F.btrim(text, F.lit(" <>[](){}.,;:\"'")))
    domain = F.substring_index(text, "@", -1)
    shape = (F.length(text) <= 254) & text.rlike(r"(?U)^[^@\s]+@[^@\s]+\.[^@\s]+$") & (F.length(F.substring_index(text, "@", 1)) <= 64)
    return F.when(shape & ~F.contains(text, F.lit("..")) & ~domain.startswith("-") & ~domain.endswith("-"), text).otherwise(MISSING)


def phone(value: Column) -> Column:
    """A French number as five pairs of digits, or the missing label; extensions are cut off."""
    text = present(value)
    text = F.when(F.lower(text).startswith("tel:"), F.substring(text, 5, 1 << 30)).otherwise(text)
    number = F.regexp_replace(F.regexp_replace(text, r"(?iU)\b(?:poste|post|ext|extension)\b.*$", ""), "[^+0-9]", "")
    number = F.regexp_replace(F.regexp_replace(number, "^0033", "+33"), r"^\+330", "+33")
    number = F.regexp_replace(number, r"^\+33(?=[1-9][0-9]{8}$)", "0")
    pairs = F.regexp_replace(number, "^(..)(..)(..)(..)(..)$", "$1 $2 $3 $4 $5")
    return F.when(number.rlike("^0[1-9][0-9]{8}$"), pairs).otherwise(MISSING)


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _URL, group)


def _hostname(authority: Column) -> Column:
    """Lower-case host of an authority: what is before ``@`` and the port go."""
    return F.lower(F.regexp_extract(authority, r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1))


def _rebuilt(scheme: Column, authority: Column, path: Column, query: Column) -> Column:
    return F.concat(scheme, F.lit("://"), authority, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def website(value: Column) -> Column:
    """An http or https address with a dotted host, lower-case scheme and no fragment, or the missing label."""
    text = present(value)
    url = F.when(F.contains(text, F.lit("://")), text).otherwise(F.concat(F.lit("https://"), text))
    scheme = F.lower(_part(url, 1))
    good = scheme.isin("http", "https") & F.contains(_hostname(_part(url, 2)), F.lit("."))
    return F.when((text != MISSING) & good, _rebuilt(scheme, _part(url, 2), _part(url, 3), _part(url, 4))).otherwise(MISSING)


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and authority, ``/`` for no path, no fragment; the query stays."""
    path = F.when(_part(url, 3) == "", "/").otherwise(_part(url, 3))
    return _rebuilt(F.lower(_part(url, 1)), F.lower(_part(url, 2)), path, _part(url, 4))


def url_host(url: Column) -> Column:
    return F.regexp_replace(_hostname(_part(url, 2)), r"^www\.", "")


def url_origin(url: Column) -> Column:
    return F.concat(_part(url, 1), F.lit("://"), _part(url, 2), F.lit("/"))


def url_path(url: Column) -> Column:
    return _part(url, 3)


def evidence_key(url: Column) -> Column:
    """What two mentions of a page have in common: no fragment, no slash at the end."""
    return F.regexp_replace(F.substring_index(url, "#", 1), "/+$", "")


def is_public_syntax(url: Column) -> Column:
    """What can be said of a public address without looking it up: scheme, no user, usual port, no local name."""
    authority = _part(url, 2)
    host, port = _hostname(authority), F.regexp_extract(authority, r":([0-9]*)$", 1)
    local = host.isin("", "localhost", "localhost.localdomain") | host.endswith(".local") | host.endswith(".internal")
    return _part(url, 1).isin("http", "https") & ~F.contains(authority, F.lit("@")) & port.isin("", "80", "443") & ~local


def same_contact(field: str, existing: Column, candidate: Column) -> Column:
    """Whether a new value is what a cell already holds, in the terms of its field."""
    found = (F.coalesce(existing, F.lit("")) != "") & (candidate != MISSING)
    if field == "phone":
        return found & (digits(existing) == digits(candidate))
    strip = (lambda x: F.regexp_replace(F.lower(x), "/+$", "")) if field == "website" else F.lower
    return found & (strip(existing) == strip(candidate))


def contact_key(field: str, value: Column) -> Column:
    """What evaluation compares: e-mail without case, phone digits, host without www and path without slash."""
    if field == "phone":
        return digits(value)
    if field == "email":
        return F.btrim(F.lower(value))
    url = F.when(F.contains(value, F.lit("://")), value).otherwise(F.concat(F.lit("https://"), value))
    return F.concat(url_host(url), F.regexp_replace(url_path(url), "/+$", ""))


def contacts_match(field: str, baseline: Column, candidate: Column) -> Column:
    return is_found(baseline) & is_found(candidate) & (contact_key(field, baseline) == contact_key(field, candidate))


def url_list(values: Column, cap: int) -> Column:
    """Valid addresses of an array, first occurrences in order, at most ``cap``."""
    valid = F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), website), lambda x: x != MISSING)
    return F.slice(F.array_distinct(valid), 1, cap)


def union_distinct(first: Column, second: Column, cap: int = 30) -> Column:
    """Both arrays' values in order, each once, at most ``cap``."""
    empty = F.array().cast("array<string>")
    return F.slice(F.array_distinct(F.concat(F.coalesce(first, empty), F.coalesce(second, empty))), 1, cap)


def source_list(cell: Column) -> Column:
    """A cell's sources: a JSON list, or lines if it is no JSON; other JSON is an empty list. Blanks are dropped."""
    text = F.btrim(F.coalesce(cell, F.lit("")))
    parsed = F.try_parse_json(text)
    listed = F.when(F.schema_of_variant(parsed).startswith("ARRAY"), F.from_json(text, "array<string>"))
    found = F.when(parsed.isNull(), F.split(text, r"\R")).otherwise(F.coalesce(listed, F.array().cast("array<string>")))
    return F.filter(F.transform(found, lambda x: F.btrim(x)), lambda x: x.isNotNull() & (x != ""))


def any_of(*tests: Column) -> Column:
    return reduce(lambda a, b: a | b, tests)
