"""Plans whose work is spread and done once, on tables that lie in one file."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from siftline import queries, site_queries
from siftline.operators import crawl, pages
from siftline.sources import tables

SF = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sites_are_dealt_over_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert site_queries.site_pages(spark, SF).rdd.getNumPartitions() >= 3 * cores
    assert tables.dealt(spark.range(tables.ROWS_A_TASK * 20 + 1, numPartitions=1)).rdd.getNumPartitions() == max(cores, 21)


def test_walks_do_not_parse_again(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(crawl, "crawl", lambda starts, facts, keep: seen.append(facts))
    site_queries.crawl_pages(spark, SF)
    assert "parsed(" not in plan(seen[0]) and seen[0].count() == site_queries.site_pages(spark, SF).count()


def test_parsed_fields_are_handed_on_in_pieces():
    texts = pd.Series([None, "a" * 10, "b" * pages.HTML_AT_ONCE, "", "c"])
    runs = list(pages.html_runs(texts))
    assert [(r.start, r.stop) for r in runs] == [(0, 3), (3, 5)] and not list(pages.html_runs(texts[:0]))
    many = pd.Series(["x" * 1000] * 5000)
    assert max(many.iloc[r].str.len().sum() for r in pages.html_runs(many)) <= pages.HTML_AT_ONCE + 1000


@pytest.mark.parametrize("name", ["page_links", "link_region", "link_keywords", "page_text"])
def test_pages_are_parsed_once(spark, name):
    assert plan(queries.QUERIES[name].run(spark, SF)).count("ArrowEvalPython [parsed(") == 1


def test_pieces_keep_rows_together(spark, monkeypatch):
    rows = [(i, f"https://h/{i}", f"<p>text {i}</p>" + "x" * 3000 * (i % 7)) for i in range(1500)]
    got = pages.parse(spark.createDataFrame(rows, "id int, url string, html string").coalesce(1)).select("id", F.split("text", "\n")[0].alias("t")).collect()
    assert len(got) == 1500 and all(r.t == f"text {r.id}" for r in got)


def test_json_ld_pages_are_parsed_once(spark):
    assert plan(site_queries.json_ld_records(spark, SF)).count("ArrowEvalPython [parsed(") == 1


def test_candidates_are_brought_into_form_once(spark):
    parsed = spark.createDataFrame([], f"id int, {pages.PARSED}")
    tests = [line for line in pages.candidates(parsed, ["id"])._jdf.queryExecution().optimizedPlan().toString().splitlines() if line.strip(" :+-").startswith("Filter")]
    assert tests and not any("regexp_replace" in line for line in tests)


def test_invalid_and_reversed_candidates(spark):
    page = {"id": 1} | pages.parse_page("https://a.fr", "<a href='mailto:rf.a%40tcatnoc'>m</a><a href='mailto:nobody'>x</a><a href='mailto:none@b..fr'>y</a><a href='tel:12'>z</a><p>04 22 33 44 55 Info@A.fr info@a.fr</p>")
    parsed = spark.createDataFrame([tuple(page.values())], f"id int, {pages.PARSED}")
    got = {(r.field, r.value, r.method) for r in pages.candidates(parsed, ["id"]).collect()}
    assert got == {("email", "contact@a.fr", "reversed_mailto"), ("email", "info@a.fr", "visible_text"), ("phone", "04 22 33 44 55", "visible_text")}
