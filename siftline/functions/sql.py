"""The operators under SQL: functions and table functions that a session knows by name once they are registered.

    register(spark)
    spark.sql("SELECT p.page_id, l.href FROM pages p, LATERAL page_links(p.url, p.html) l WHERE l.legal")

Table functions give a row per link, candidate, registry number or finding, so that WHERE, GROUP BY and joins take it
from there; Catalyst prunes columns and pushes filters on the other side of a LATERAL as for any join.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from siftline.functions.search_text import search_key_of
from siftline.operators import pages, responses


class _PageLinks:
    """Links of a page in their order: what ``pages.parse`` says of each, by number."""

    def eval(self, url: str, html: str) -> Iterator[tuple]:
        for i, x in enumerate(pages.parse_page(url or "", html)["links"]):
            yield i, x["href"], x["label"], x["region"], x["target"], x["host"], x["contact"], x["legal"], x["popup"]


class _PageCandidates:
    """Addresses and numbers of a page in the order in which they are discovered."""

    def eval(self, url: str, html: str) -> Iterator[tuple]:
        for x in pages.parse_page(url or "", html)["candidates"]:
            yield x["ordinal"], x["field"], x["raw"], x["reversed"], x["method"], x["context"]


class _PageNumbers:
    """Registry numbers of a page."""

    def eval(self, url: str, html: str) -> Iterator[tuple]:
        for x in pages.parse_page(url or "", html)["identifiers"]:
            yield x["value"], x["context_key"]


class _Contacts:
    """Addresses, then numbers, of a running text with what stands around each."""

    def eval(self, text: str) -> Iterator[tuple]:
        for field, found in (("email", pages.found_emails(text or "")), ("phone", pages.found_phones(text or ""))):
            for i, (raw, around) in enumerate(found):
                yield field, i, raw, around


TABLE_FUNCTIONS = {
    "page_links": (_PageLinks, "place int, href string, label string, region string, target string, host string, contact boolean, legal boolean, popup boolean"),
    "page_candidates": (_PageCandidates, "ordinal int, field string, raw string, reversed boolean, method string, context string"),
    "page_numbers": (_PageNumbers, "value string, context_key string"),
    "contacts_in": (_Contacts, "field string, place int, raw string, context string"),
}


@F.pandas_udf(StringType())
def _search_key(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else search_key_of(t))


@F.pandas_udf(StringType())
def _page_text(pages_: pd.Series) -> pd.Series:
    return pages_.map(lambda p: pages.parse_page("", p)["text"])


@F.pandas_udf(StringType())
def _first_json_object(texts: pd.Series) -> pd.Series:
    return texts.map(responses.first_object)


FUNCTIONS = {"search_key": _search_key, "page_text": _page_text, "first_json_object": _first_json_object}


def register(spark: SparkSession) -> None:
    """Make all functions known to the session; a second call replaces them by the same."""
    for name, (handler, schema) in TABLE_FUNCTIONS.items():
        spark.udtf.register(name, F.udtf(handler, returnType=schema, useArrow=True))
    for name, function in FUNCTIONS.items():
        spark.udf.register(name, function)
