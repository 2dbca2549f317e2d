"""Company, journal and evaluation tables derived from the star-schema test tables, in SQL that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_K = "CAST(c_custkey AS STRING)"
_S = "CAST(10000000000000 + c_custkey * 7919 AS STRING)"
_D = "lpad(CAST((c_custkey * 7919) % 100000000 AS STRING), 8, '0')"

COMPANIES = f"""
SELECT CAST(c_custkey + 2 AS INT) AS row_index,
  CASE WHEN c_custkey % 17 = 0 THEN concat('SIRET-', {_K})
       WHEN c_custkey % 3 = 0 THEN concat(substr({_S}, 1, 3), ' ', substr({_S}, 4, 3), ' ', substr({_S}, 7, 3), ' ', substr({_S}, 10, 5)) ELSE {_S} END AS siret,
  CASE WHEN c_custkey % 29 = 0 THEN '' WHEN c_custkey % 4 = 0 THEN concat('SARL ', c_name) WHEN c_custkey % 4 = 1 THEN concat(c_name, ' SAS') ELSE c_name END AS company_name,
  CAST(NULL AS STRING) AS address,
  CAST(1000 + c_custkey % 95000 AS STRING) AS postal_raw,
  n_name AS city,
  CASE c_custkey % 8 WHEN 0 THEN concat('mailto:Contact', {_K}, '@Example.FR') WHEN 1 THEN concat(' <info', {_K}, '@example.com>; ') WHEN 2 THEN 'unknown' WHEN 4 THEN 'Non trouvé'
    WHEN 5 THEN concat('a..b', {_K}, '@example.com') WHEN 6 THEN 'not-an-email' WHEN 7 THEN concat('user', {_K}, '@sub.example.org') END AS email,
  CASE c_custkey % 9 WHEN 0 THEN concat('+33 1 ', {_D}) WHEN 1 THEN concat('00336', {_D}) WHEN 2 THEN concat('+33(0)2', {_D}) WHEN 3 THEN concat('04.', {_D}) WHEN 4 THEN concat('tel:05', {_D})
    WHEN 5 THEN concat('03', {_D}, ' poste 12') WHEN 6 THEN concat('00', {_D}) WHEN 8 THEN 'n/a' END AS phone,
  CASE c_custkey % 6 WHEN 0 THEN concat('www.example-', {_K}, '.fr/accueil') WHEN 1 THEN concat('HTTP://Example-', {_K}, '.COM/a/b?x=1#top') WHEN 2 THEN concat('ftp://example-', {_K}, '.com') WHEN 3 THEN 'localhost'
    WHEN 5 THEN concat('https://example-', {_K}, '.org?q=', {_K}) END AS website,
  CASE c_custkey % 7 WHEN 0 THEN 'success' WHEN 1 THEN 'not_found' WHEN 2 THEN 'technical_error' WHEN 3 THEN 'invalid_input' WHEN 5 THEN 'weird' END AS status
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
"""

JOURNAL = """
SELECT CAST(event_id AS BIGINT) AS line_no, CAST(user_id + 2 AS INT) AS row_index,
  CASE event_type WHEN 'purchase' THEN 'success' WHEN 'view' THEN 'not_found' WHEN 'error' THEN 'technical_error' WHEN 'signup' THEN 'invalid_input' ELSE 'success' END AS status,
  event_type <> 'error' AS has_result,
  CASE event_type WHEN 'purchase' THEN concat('u', CAST(event_id AS STRING), '@example.com') WHEN 'error' THEN NULL ELSE 'Non trouvé' END AS email,
  event_id % 50 = 0 AS overwrite_existing
FROM {events}
"""

EVALS = """
SELECT o_orderpriority AS deployment, CAST(o_orderkey AS BIGINT) AS row_index,
  CASE WHEN o_orderkey % 3 = 0 THEN 'not_found' ELSE 'success' END AS baseline_status,
  CASE WHEN o_orderkey % 11 = 0 THEN 'technical_error' WHEN o_orderkey % 4 = 0 THEN 'not_found' ELSE 'success' END AS candidate_status,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Non trouvé' ELSE concat('A', CAST(o_orderkey AS STRING), '@Example.com') END AS baseline_email,
  CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 11 = 0 THEN 'Non trouvé' WHEN o_orderkey % 5 = 0 THEN 'b@example.com' ELSE concat('a', CAST(o_orderkey AS STRING), '@example.com') END AS candidate_email,
  CASE WHEN o_orderkey % 6 = 0 THEN 'Non trouvé' ELSE concat('01 ', CAST(10000000 + o_orderkey % 90000000 AS STRING)) END AS baseline_phone,
  CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'Non trouvé' ELSE concat('01', CAST(10000000 + o_orderkey % 90000000 AS STRING)) END AS candidate_phone,
  CASE WHEN o_orderkey % 5 = 0 THEN 'Non trouvé' ELSE concat('https://www.Example-', CAST(o_orderkey AS STRING), '.com/') END AS baseline_website,
  CASE WHEN o_orderkey % 10 = 0 OR o_orderkey % 11 = 0 THEN 'Non trouvé' WHEN o_orderkey % 9 = 0 THEN 'other.example.com' ELSE concat('example-', CAST(o_orderkey AS STRING), '.com') END AS candidate_website,
  CASE WHEN o_orderkey % 11 = 0 THEN 'TimeoutError' ELSE '' END AS error_type,
  100 + o_orderkey % 900 AS input_tokens, 20 + o_orderkey % 50 AS output_tokens, 120 + o_orderkey % 900 + o_orderkey % 50 AS total_tokens,
  o_orderkey % 7 AS web_search_calls, o_orderkey % 4 % 3 AS deterministic_fields_found, (o_orderkey % 5000) / 8.0 AS latency_seconds,
  o_orderkey % 13 = 0 AS legal_popup_detected, CASE WHEN o_orderkey % 8 = 0 THEN 'site_siret_or_siren' ELSE 'llm_web_search' END AS identity_extraction_method,
  o_orderkey % 7 AS pages_fetched
FROM {orders}
"""


def for_duckdb(sql: str) -> str:
    return sql.format(customer="customer", nation="nation", events="events", orders="orders")


def _of(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, COMPANIES, "customer", "nation")


def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, JOURNAL, "events")


def evals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, EVALS, "orders")
