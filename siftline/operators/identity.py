"""Does a page belong to a company, and which of its contact candidates is the best."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions import values as V
from siftline.functions.search_text import CONTACT_LINK_WORDS, CONTACT_WORDS, LEGAL_LINK_WORDS, address_words, has_word, name_key, search_key

# Points by where a candidate was found, the score that is enough, and words that tell of others.
POINTS = {"mailto": 45, "reversed_mailto": 50, "tel_link": 45, "visible_text": 25, "reversed_visible_text": 30, "json_ld": 55}
OTHER_POINTS, ENOUGH = 20, 65
SUPPORT_WORDS = ("support", "service client", "assistance", "annuaire")
GENERIC_LOCAL_PARTS = ("contact", "info", "support", "bonjour", "hello", "admin")


def company_keys(companies: DataFrame) -> DataFrame:
    """``companies`` with the search keys of their names, addresses and places, made once per company."""
    out = companies.withColumns({f"{c}_key": search_key(F.coalesce(F.col(c), F.lit(""))) for c in ("company_name", "address", "postal_code", "city")})
    return out.withColumn("name_key", name_key(F.col("company_name_key"))).withColumn("siret_digits", V.digits(F.coalesce("siret", F.lit(""))))


def compact(key: Column) -> Column:
    return F.regexp_replace(key, " ", "")


def contains_key(text_key: Column, key: Column) -> Column:
    return (F.coalesce(key, F.lit("")) != "") & F.contains(text_key, key)


def name_matches(text_key: Column, key: Column) -> Column:
    """A name of four characters or more, spaces aside, occurs in the text."""
    return (F.length(key) >= 4) & F.contains(compact(text_key), key)


def address_matches(text_key: Column, address_key: Column, postal_key: Column) -> Column:
    """Two telling words of the address (or its only one) are in the text, and the postal code if there is one."""
    words = address_words(address_key)
    hits = F.size(F.filter(words, lambda w: F.array_contains(F.split(text_key, " "), w)))
    postal = (F.coalesce(postal_key, F.lit("")) == "") | F.contains(text_key, postal_key)
    return (F.size(words) > 0) & (hits >= F.least(F.lit(2), F.size(words))) & postal


def page_identity(rows: DataFrame) -> DataFrame:
    """``rows`` (company keys beside a parsed page) with match_type, name_matches, location_matches, conflicting."""
    own = lambda x: x.isin(F.col("siret_digits"), F.substring("siret_digits", 1, 9))
    exact = F.exists("identifiers", lambda x: own(x["value"]))
    foreign = F.exists("identifiers", lambda x: ~own(x["value"]) & name_matches(x["context_key"], F.col("name_key")))
    rows = rows.withColumns({
        "name_matches": name_matches(F.col("text_key"), F.col("name_key")),
        "_address": address_matches(F.col("text_key"), F.col("address_key"), F.col("postal_code_key")),
        "_city": contains_key(F.col("text_key"), F.col("city_key")),
        "_exact": exact,
    })
    kind = F.when(F.col("_exact"), "siret").when(F.col("name_matches") & F.col("_address"), "name_and_address").when(F.col("name_matches") & F.col("_city"), "name_and_city").otherwise("none")
    out = rows.withColumns({"match_type": kind, "location_matches": F.col("_address") | F.col("_city"), "conflicting": ~F.col("_exact") & foreign})
    return out.drop("_address", "_city", "_exact")


def path_key(url: Column) -> Column:
    """The path of an address as a search key; paths that hold other than ASCII are rare enough for plain rules."""
    return F.btrim(F.regexp_replace(F.lower(V.url_path(url)), "[^a-z0-9]+", " "))


def on_root(url: Column) -> Column:
    return V.url_path(url).isin("", "/")


def score() -> Column:
    """Points of a candidate row: method, context_key, header, url, match_type beside the company's keys."""
    context, url = F.col("context_key"), F.col("url")
    base = F.lit(OTHER_POINTS)
    for method, points in POINTS.items():
        base = F.when(F.col("method") == method, points).otherwise(base)
    named = (F.col("name_key") != "") & F.contains(compact(context), F.col("name_key"))
    placed = contains_key(context, F.col("city_key")) | contains_key(context, F.col("postal_code_key"))
    others = F.col("header") & V.any_of(*[F.contains(context, F.lit(w)) for w in SUPPORT_WORDS])
    add = lambda test, points: F.when(test, points).otherwise(0)
    return base + add(named, 25) + add(placed, 15) + add(has_word(context, CONTACT_WORDS), 15) + add(has_word(path_key(url), (*CONTACT_LINK_WORDS, *LEGAL_LINK_WORDS)), 10) + add(on_root(url), 10) + add(F.col("match_type") == "siret", 5) - add(others, 50)


def is_platform_email() -> Column:
    """A generic address of the website's own domain, off its root page, where company and site share no name."""
    local, domain = F.substring_index("value", "@", 1), F.regexp_replace(F.lower(F.substring_index("value", "@", -1)), r"^www\.", "")
    host = V.url_host(F.col("website"))
    host_key = F.regexp_replace(F.substring_index(host, ".", 1), "[^a-z0-9]", "")
    apart = (F.col("name_key") != "") & ~F.contains(host_key, F.col("name_key")) & ~F.contains(F.col("name_key"), host_key)
    return (F.col("method") == "json_ld") & (domain == host) & local.isin(*GENERIC_LOCAL_PARTS) & ~on_root(F.col("website")) & apart


def site_verified(pages: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and whether the site shows the company's number where it must: a legal page, or a root page naming it."""
    legal = has_word(path_key(F.col("url")), LEGAL_LINK_WORDS)
    proof = (F.col("match_type") == "siret") & (legal | (on_root(F.col("url")) & F.col("name_matches") & F.col("location_matches")))
    return pages.groupBy(*keys).agg(F.max(proof).alias("site_verified"))


def is_eligible() -> Column:
    """A candidate's page may speak for the company."""
    return ~F.col("conflicting") & ((F.col("match_type") != "none") | F.col("site_verified") | (F.col("identity_verified") & F.col("name_matches")))


def best(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of scored candidates the best per ``keys`` and field: score, then the shorter address, then the first found.

    A minimum over a struct combines map-side, where a window would bring all candidates of a key together.
    """
    order = F.struct((-F.col("score")).alias("o1"), F.length("url").alias("o2"), F.col("page_no").alias("o3"), F.col("ordinal").alias("o4"), F.col("value"), F.col("url"), F.col("method"), F.col("score"))
    enough = rows.filter(F.col("score") >= ENOUGH).groupBy(*keys, "field").agg(F.min(order).alias("b"))
    return enough.select(*keys, "field", "b.value", "b.url", "b.method", "b.score")


def ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """All candidates with their rank, for reports."""
    w = Window.partitionBy(*keys, "field").orderBy(F.desc("score"), F.length("url"), "page_no", "ordinal")
    return rows.withColumn("rank", F.row_number().over(w))
