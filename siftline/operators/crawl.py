"""Bounded breadth-first walks of companies' sites over a table of stored pages.

A walk's state is small (at most a few dozen addresses), so each round joins all addresses that walks wait for with the
parsed pages, by address, and then carries every walk on as far as its pages allow. Rounds follow the depth of the
sites, not the number of pages; no site's pages are gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions import values as V

# Pages tried where the first page links to none.
CONTACT_PATHS = ("/contact", "/nous-contacter", "/contactez-nous")
LEGAL_PATHS = ("/mentions-legales", "/mentions-legales/")
MAX_PAGES = 6
PAGE_FACTS = "struct<requested: string, final_url: string, host: string, links: array<struct<target: string, host: string, contact: boolean, legal: boolean>>, has_email: boolean, has_phone: boolean>"


def page_facts(parsed: DataFrame) -> DataFrame:
    """What a walk needs to know of a page (requested, url: the final address, and the parsed fields)."""
    links = F.transform(F.filter("links", lambda x: x["target"].isNotNull() & (x["contact"] | x["legal"])), lambda x: F.struct(x["target"].alias("target"), x["host"].alias("host"), x["contact"].alias("contact"), x["legal"].alias("legal")))
    has = lambda field: F.exists("candidates", lambda c: c["field"] == field)
    return parsed.select(F.struct("requested", F.col("url").alias("final_url"), V.url_host(F.col("url")).alias("host"), links.alias("links"), has("email").alias("has_email"), has("phone").alias("has_phone")).alias("fact"))


def walk(start: str, needs_email: bool, needs_phone: bool, seen: dict[str, dict | None], max_pages: int) -> tuple[list[str], list[str]]:
    """(addresses of the pages read, addresses it waits for) of a walk that knows the pages in ``seen`` (None: absent)."""
    queue, known, read, root = [start], {start}, [], None
    while queue and len(read) < max_pages:
        if queue[0] not in seen:
            return read, [u for u in queue if u not in seen]
        url = queue.pop(0)
        page = seen[url]
        if page is None or (root is not None and page["host"] != root):
            continue
        root = page["host"]
        read.append(url)
        own = [x for x in page["links"] if x["host"] == root]
        contact = list(dict.fromkeys(x["target"] for x in own if x["contact"]))
        legal = list(dict.fromkeys(x["target"] for x in own if x["legal"]))
        wanting = (needs_email and not page["has_email"]) or (needs_phone and not page["has_phone"])
        for link in [*legal, *(contact if wanting else ())]:
            if link not in known and len(known) < 3 * max_pages:
                queue.append(link)
                known.add(link)
        if len(read) == 1:
            tried = [*(CONTACT_PATHS if wanting and not contact else ()), *(LEGAL_PATHS if not legal else ())]
            for link in (urljoin(page["final_url"], p) for p in tried):
                if link not in known:
                    queue.append(link)
                    known.add(link)
    return read, []


def crawl(starts: DataFrame, facts: DataFrame | Callable[[DataFrame], DataFrame], max_pages: int = MAX_PAGES, keep=lambda df: df.checkpoint()) -> DataFrame:
    """(row_index, page_no, requested): the pages each walk reads, in order.

    ``starts`` is (row_index, start, needs_email, needs_phone); ``facts`` as ``page_facts`` gives, or a function that
    gives those of a round's (url), distinct: pages that are fetched as walks ask for them. A page that it doesn't give
    is absent. ``keep`` cuts the lineage of a round's state (a reliable checkpoint by default).
    """
    if not 1 <= max_pages <= 12:
        raise ValueError("a walk reads 1 to 12 pages")
    state_type = f"struct<pages: array<string>, waits: array<string>>"  # noqa: F541

    @F.pandas_udf(state_type)
    def carried_on(start: pd.Series, email: pd.Series, phone: pd.Series, seen: pd.Series, absent: pd.Series) -> pd.DataFrame:
        out = []
        for s, e, p, facts_of, none in zip(start, email, phone, seen, absent, strict=True):
            known = {u: None for u in none} | {f["requested"]: f for f in facts_of}
            out.append(walk(s, e, p, known, max_pages))
        return pd.DataFrame(out, columns=["pages", "waits"])

    empty_facts, empty = F.array().cast(f"array<{PAGE_FACTS}>"), F.array().cast("array<string>")
    walks = starts.withColumns({"seen": empty_facts, "absent": empty, "waits": F.array("start"), "pages": empty})
    finished = []
    while True:
        asked = walks.select("row_index", F.explode("waits").alias("url"))
        known = facts(asked.select("url").distinct()) if callable(facts) else facts
        got = asked.join(known, F.col("url") == F.col("fact.requested"), "left").groupBy("row_index").agg(
            F.array_distinct(F.collect_list("fact")).alias("new"), F.collect_set(F.when(F.col("fact").isNull(), F.col("url"))).alias("gone")
        )
        walks = walks.join(got, "row_index", "left")
        walks = walks.withColumn("seen", F.concat("seen", F.coalesce("new", empty_facts))).withColumn("absent", F.array_union("absent", F.coalesce("gone", empty))).drop("new", "gone")
        walks = walks.withColumn("state", carried_on("start", "needs_email", "needs_phone", "seen", "absent"))
        walks = keep(walks.withColumns({"pages": F.col("state.pages"), "waits": F.col("state.waits")}).drop("state"))
        finished.append(walks.filter(F.size("waits") == 0).select("row_index", "pages"))
        walks = walks.filter(F.size("waits") > 0)
        if walks.isEmpty():
            break
    return reduce(DataFrame.union, finished).select("row_index", F.posexplode("pages").alias("page_no", "requested"))
