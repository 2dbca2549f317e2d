"""Pages that walks ask for, fetched round by round, parsed once, and kept: a second run asks only for what is new.

A round's addresses are distinct over all walks. Those of one host are dealt to one task, which waits between two
requests to the same host; hosts with many addresses in a round are the exception that a walk's page limit bounds: each
company's walk asks a site for a few dozen at most, and companies that share a site share its pages.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions import values as V
from siftline.operators import crawl, pages
from siftline.sources import versions, web

_PARSED = pages.PARSED
_FETCHED = "requested string, url string, html string"


class Fetched:
    """Pages under ``folder``: what was fetched and what it parses to, a folder for each round; absent pages are kept too.

    ``stored`` (requested, url, html) are pages that are there already. ``fetcher`` gives (final address, html) of an
    address or none; ``host_gap_s`` is the least time between two requests to one host, which redirects don't count
    against.
    """

    def __init__(self, spark: SparkSession, folder: str, stored: DataFrame | None = None, fetcher: Callable[[str], tuple[str, str] | None] | None = None, concurrency: int = 4, host_gap_s: float = 1.0) -> None:
        self.spark, self.folder, self.stored = spark, folder.rstrip("/"), stored
        self.fetcher, self.concurrency, self.host_gap_s = fetcher, concurrency, host_gap_s

    def _rounds(self, part: str, schema: str) -> DataFrame:
        whole = [f"{self.folder}/{part}/{r}" for r in versions.folders(self.spark, f"{self.folder}/{part}") if versions.exists(self.spark, f"{self.folder}/{part}/{r}/_SUCCESS")]
        return self.spark.read.schema(schema).parquet(*whole) if whole else self.spark.createDataFrame([], schema)

    def pages(self) -> DataFrame:
        """(requested, url, html) of all rounds so far; url and html are null where there was no page."""
        return self._rounds("pages", _FETCHED)

    def parsed(self) -> DataFrame:
        """(requested, url and the fields of ``pages.PARSED``) of all pages so far."""
        return self._rounds("parsed", f"requested string, url string, {_PARSED}")

    def facts(self, asked: DataFrame) -> DataFrame:
        """What walks need to know of the pages at ``asked`` (url, distinct); those that aren't known yet are fetched.

        A round's pages are written before they are parsed, so a round that breaks off asks for none of them again.
        """
        name, known = uuid.uuid4().hex, self.pages()
        new = asked.join(known.select(F.col("requested").alias("url")), "url", "left_anti")
        if self.stored is not None:
            new = new.join(self.stored.select(F.col("requested").alias("url"), F.struct(F.col("url").alias("final"), "html").alias("page")).dropDuplicates(["url"]), "url", "left")
        else:
            new = new.withColumn("page", F.lit(None).cast("struct<final: string, html: string>"))
        there = new.filter("page IS NOT NULL").select(F.col("url").alias("requested"), F.col("page.final").alias("url"), "page.html")
        self._fetch(new.filter("page IS NULL").select("url")).unionByName(there).write.parquet(f"{self.folder}/pages/{name}")
        # whatever has a page but isn't parsed yet, this round's and those of a round that broke off
        left = self.pages().filter("html IS NOT NULL").join(self.parsed().select("requested"), "requested", "left_anti")
        pages.parse(left.groupBy("requested").agg(F.min(F.struct("url", "html")).alias("p")).select("requested", "p.url", "p.html")).write.parquet(f"{self.folder}/parsed/{name}")
        return crawl.page_facts(self.parsed().join(asked.withColumnRenamed("url", "requested"), "requested", "left_semi"))

    def _fetch(self, urls: DataFrame) -> DataFrame:
        fetcher, gap = self.fetcher, self.host_gap_s

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            get = fetcher or web.client()
            last: dict[str, float] = {}
            for pdf in batches:
                for host, url in zip(pdf["host"], pdf["url"], strict=True):
                    now = time.monotonic()
                    wait = last.get(host, now - gap) + gap - now
                    if wait > 0:
                        time.sleep(wait)
                    last = {host: time.monotonic()}  # rows come host by host
                    final, html = get(url) or (None, None)
                    yield pd.DataFrame({"requested": [url], "url": [final], "html": [html]})

        by_host = urls.withColumn("host", V.url_host(F.col("url"))).repartition(self.concurrency, "host").sortWithinPartitions("host", "url")
        return by_host.select("host", "url").mapInPandas(run, _FETCHED)
