"""Queries over web sites that are derived from the customer table: scans, JSON-LD, walks, enrichment from sites."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions import values as V
from siftline.operators import crawl, enrich, pages
from siftline.sources import derived, tables

#: Every customer has a site of a page or three, but each sixth has none; what a page says depends on the customer's key.
SITES = """
SELECT c_custkey AS k, CAST(c_custkey + 2 AS INT) AS row_index, concat('https://site-', CAST(c_custkey AS STRING), '.fr') AS site, c_name AS name, n_name AS city,
  CAST(10000000000000 + c_custkey * 7919 AS STRING) AS siret, lpad(CAST(c_custkey % 100 AS STRING), 2, '0') AS tail, CAST(c_custkey AS STRING) AS ks
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""
_ROOT = """concat('<header><nav>', name, '</nav></header><main><p>', name, '</p></main><footer><a href="/mentions-legales">Mentions légales</a><a href="ecrire">Nous contacter</a></footer>',
  CASE WHEN k % 5 = 0 THEN concat('<script type="application/ld+json">{{"@graph": [{{"name": "', name, '", "email": "ld', ks, '@site-', ks, '.fr"}}, {{"more": {{"telephone": "+33 1 11 11 11 ', tail, '"}}}}]}}</script>') ELSE '' END)"""
PAGES = f"""
SELECT concat(site, '/') AS requested, concat(site, '/') AS url, {_ROOT} AS html FROM ({SITES}) WHERE k % 6 <> 0
UNION ALL SELECT concat(site, '/mentions-legales'), concat(site, '/mentions-legales'), concat('<p>', name, CASE WHEN k % 3 = 0 THEN concat(', SIRET ', siret) ELSE '' END, '</p>') FROM ({SITES}) WHERE k % 6 <> 0
UNION ALL SELECT concat(site, '/ecrire'), concat(site, '/ecrire'), concat('<p>', name, ' contact : mail', ks, '@site-', ks, '.fr, tel 04 22 33 44 ', tail, '</p>') FROM ({SITES}) WHERE k % 6 <> 0 AND k % 4 <> 0
"""
_WITH = f"WITH s AS ({derived.for_duckdb(SITES)})"


def _sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    customer, nation = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "nation"))
    return spark.sql(sql, customer=tables.dealt(customer), nation=nation)


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(requested, url, html) of the derived sites."""
    return _sql(spark, sf_dir, PAGES)


def phone_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in running text, with what stands around them."""
    found = _sql(spark, sf_dir, SITES).select("k", F.posexplode(pages.scanned_phones(F.expr(_TEXT))).alias("place", "x"))
    return found.select(F.col("k").alias("id"), "place", F.col("x.raw").alias("raw"), F.length("x.context").alias("around"))


def json_ld_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses and numbers in JSON-LD at any depth, with the mapping that says them."""
    found = pages.parse(site_pages(spark, sf_dir)).select("url", F.explode("candidates").alias("x")).filter("x.method = 'json_ld'")
    return found.select("url", F.col("x.field").alias("field"), F.col("x.raw").alias("raw"), F.col("x.context").alias("context"), F.col("x.ordinal").alias("place"))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = F.lit(V.MISSING)
    return _sql(spark, sf_dir, SITES).select(
        "row_index", missing.alias("email"), F.when(F.col("k") % 7 == 0, "01 00 00 00 00").otherwise(missing).alias("phone"), F.col("site").alias("website"), F.lit("official_site").alias("website_type"),
        (F.col("k") % 2 == 0).alias("identity_verified"), F.when(F.col("k") % 2 == 0, "name_and_city").otherwise("none").alias("identity_match_type"),
    )


def crawl_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages that each company's walk reads, in order."""
    starts = _results(spark, sf_dir).select("row_index", F.concat("website", F.lit("/")).alias("start"), F.lit(True).alias("needs_email"), (F.col("phone") == V.MISSING).alias("needs_phone"))
    return crawl.crawl(starts, _kept(crawl.page_facts(pages.parse(site_pages(spark, sf_dir)))), keep=_kept)


def site_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results filled from the companies' own sites."""
    companies = _sql(spark, sf_dir, SITES).select("row_index", "siret", F.col("name").alias("company_name"), F.lit(None).cast("string").alias("address"), F.lit(None).cast("string").alias("postal_code"), "city")
    out = enrich.enrich(companies, _results(spark, sf_dir), site_pages(spark, sf_dir), keep=_kept)
    return out.select("row_index", "email", "phone", "email_source", "email_extraction_method", "phone_extraction_method", "identity_verified", "identity_match_type", "identity_source", F.size("deterministic_pages").alias("n_pages"), "deterministic_fields_found", "legal_popup_detected")


def _kept(df: DataFrame) -> DataFrame:
    """A step written as Parquet in the session's checkpoint folder and read back; only a local session without such a
    folder takes a temporary one."""
    spark, sc = df.sparkSession, df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="siftline-"))
    path = f"{sc.getCheckpointDir()}/site-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_TEXT = "concat('Appelez le 04.22.33.44.', tail, ' ou +33 (0)6 ', tail, ' 11 22 33, pas le 104 22 33 44 ', tail, ' ni 00', tail, '. Fax 0033', 1 + k % 9, '00112233', repeat(' suite', 120))"
_ELIGIBLE = "(k % 6 <> 0 AND (k % 3 = 0 OR k % 2 = 0))"
_FOUND = f"({_ELIGIBLE} AND (k % 5 = 0 OR k % 4 <> 0))"
ORACLES = {
    "phone_scan": f"""{_WITH}, t AS (SELECT *, {_TEXT} AS text FROM s),
n AS (SELECT k, text, unnest(['04.22.33.44.' || tail, '+33 (0)6 ' || tail || ' 11 22 33', '0033' || (1 + k % 9) || '00112233']) AS raw, unnest([0, 1, 2]) AS place FROM t)
SELECT k AS id, CAST(place AS INTEGER) AS place, raw, CAST(len(substr(text, greatest(1, strpos(text, raw) - 300), least(strpos(text, raw) - 1, 300) + 300)) AS INTEGER) AS around FROM n""",
    "json_ld_records": f"""{_WITH} SELECT site || '/' AS url, 'email' AS field, 'ld' || ks || '@site-' || ks || '.fr' AS raw, '{{"name": "' || name || '", "email": "ld' || ks || '@site-' || ks || '.fr"}}' AS context, CAST(0 AS INTEGER) AS place FROM s WHERE k % 6 <> 0 AND k % 5 = 0
UNION ALL SELECT site || '/', 'phone', '+33 1 11 11 11 ' || tail, '{{"telephone": "+33 1 11 11 11 ' || tail || '"}}', CAST(1 AS INTEGER) FROM s WHERE k % 6 <> 0 AND k % 5 = 0""",
    "crawl_pages": f"""{_WITH} SELECT row_index, CAST(0 AS INTEGER) AS page_no, site || '/' AS requested FROM s WHERE k % 6 <> 0
UNION ALL SELECT row_index, CAST(1 AS INTEGER), site || '/mentions-legales' FROM s WHERE k % 6 <> 0
UNION ALL SELECT row_index, CAST(2 AS INTEGER), site || '/ecrire' FROM s WHERE k % 6 <> 0 AND k % 5 <> 0 AND k % 4 <> 0""",
    "site_enrich": f"""{_WITH} SELECT row_index,
  CASE WHEN {_FOUND} THEN CASE WHEN k % 5 = 0 THEN 'ld' ELSE 'mail' END || ks || '@site-' || ks || '.fr' ELSE 'Non trouvé' END AS email,
  CASE WHEN k % 7 = 0 THEN '01 00 00 00 00' WHEN {_FOUND} THEN CASE WHEN k % 5 = 0 THEN '01 11 11 11 ' ELSE '04 22 33 44 ' END || tail ELSE 'Non trouvé' END AS phone,
  CASE WHEN {_FOUND} THEN site || CASE WHEN k % 5 = 0 THEN '/' ELSE '/ecrire' END ELSE 'Non trouvé' END AS email_source,
  CASE WHEN {_FOUND} THEN CASE WHEN k % 5 = 0 THEN 'json_ld' ELSE 'visible_text' END ELSE '' END AS email_extraction_method,
  CASE WHEN {_FOUND} AND k % 7 <> 0 THEN CASE WHEN k % 5 = 0 THEN 'json_ld' ELSE 'visible_text' END ELSE '' END AS phone_extraction_method,
  k % 2 = 0 OR (k % 6 <> 0 AND k % 3 = 0) AS identity_verified, CASE WHEN k % 6 <> 0 AND k % 3 = 0 THEN 'siret' WHEN k % 2 = 0 THEN 'name_and_city' ELSE 'none' END AS identity_match_type,
  CASE WHEN k % 6 <> 0 AND k % 3 = 0 THEN site || '/mentions-legales' ELSE 'Non trouvé' END AS identity_source,
  CAST(CASE WHEN k % 6 = 0 THEN 0 WHEN k % 5 <> 0 AND k % 4 <> 0 THEN 3 ELSE 2 END AS INTEGER) AS n_pages,
  CAST(CASE WHEN {_FOUND} THEN CASE WHEN k % 7 = 0 THEN 1 ELSE 2 END ELSE 0 END AS INTEGER) AS deterministic_fields_found, false AS legal_popup_detected FROM s""",
}
