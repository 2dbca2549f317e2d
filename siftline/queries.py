"""One query per operator group over the test tables, and the same in SQL that DuckDB runs."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline import site_queries
from siftline.functions import search_text as T
from siftline.functions import sql as sql_functions
from siftline.functions import values as V
from siftline.operators import eligibility, evaluate, identity, journal, merge, pages, responses
from siftline.sources import derived, headers, tables

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    run: Query
    sql: str | None


QUERIES: dict[str, Registered] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = Registered(f, sql)
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_parquet(spark, f"{sf_dir}/{name}.parquet")


# ---- DuckDB forms of the value functions, on an expression x ----

_TOKENS = ", ".join(f"'{t}'" for t in V.MISSING_TOKENS)
_C = f"WITH companies AS ({derived.for_duckdb(derived.COMPANIES)})"
_E = f"WITH evals AS ({derived.for_duckdb(derived.EVALS)})"


def _ws(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[ \t\n\r\f\v]+', ' ', 'g'))"


def _clean(x: str) -> str:
    return f"nullif({_ws(x)}, '')"


def _present(x: str) -> str:
    return f"CASE WHEN lower(coalesce({_ws(x)}, '')) IN ({_TOKENS}) THEN '{V.MISSING}' ELSE {_ws(x)} END"


def _url(x: str, group: int) -> str:
    return rf"regexp_extract({x}, '^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?', {group})"


def _sql_host(x: str) -> str:
    return rf"lower(regexp_extract({_url(x, 2)}, '^(?:.*@)?([^:]*)', 1))"


def _bare_host(x: str) -> str:
    return rf"regexp_replace({_sql_host(x)}, '^www\.', '')"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def _valid(siret: str) -> str:
    return f"length({_digits(siret)}) = 14"


def _status(x: str) -> str:
    return f"CASE WHEN {_clean(x)} IN ('success', 'not_found', 'technical_error', 'invalid_input') THEN {_clean(x)} END"


_EMAIL = f"""t AS (SELECT *, {_present("email")} AS e0 FROM companies),
u AS (SELECT *, lower(trim(CASE WHEN lower(e0) LIKE 'mailto:%' THEN trim(substr(e0, 8)) ELSE e0 END, ' <>[](){{}}.,;:"''')) AS e1 FROM t),
emails AS (SELECT *, CASE WHEN length(e1) <= 254 AND regexp_full_match(e1, '[^@\\s]+@[^@\\s]+\\.[^@\\s]+') AND length(split_part(e1, '@', 1)) <= 64 AND NOT contains(e1, '..')
  AND NOT starts_with(split_part(e1, '@', 2), '-') AND NOT ends_with(e1, '-') THEN e1 ELSE '{V.MISSING}' END AS new_email FROM u)"""
_PHONE = rf"""p0 AS (SELECT *, {_present("phone")} AS f0 FROM emails),
p1 AS (SELECT *, CASE WHEN lower(f0) LIKE 'tel:%' THEN substr(f0, 5) ELSE f0 END AS f1 FROM p0),
p2 AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(f1, '(?i)\b(?:poste|post|ext|extension)\b.*$', ''), '[^+0-9]', '', 'g'), '^0033', '+33'), '^\+330', '+33') AS f2 FROM p1),
p3 AS (SELECT *, CASE WHEN regexp_full_match(f2, '\+33[1-9][0-9]{{8}}') THEN '0' || substr(f2, 4) ELSE f2 END AS f3 FROM p2),
phones AS (SELECT *, CASE WHEN regexp_full_match(f3, '0[1-9][0-9]{{8}}') THEN substr(f3, 1, 2) || ' ' || substr(f3, 3, 2) || ' ' || substr(f3, 5, 2) || ' ' || substr(f3, 7, 2) || ' ' || substr(f3, 9, 2)
  ELSE '{V.MISSING}' END AS new_phone FROM p3)"""
_SITE = f"""w0 AS (SELECT *, {_present("website")} AS s0 FROM phones),
w1 AS (SELECT *, CASE WHEN contains(s0, '://') THEN s0 ELSE 'https://' || s0 END AS s1 FROM w0),
sites AS (SELECT *, CASE WHEN s0 <> '{V.MISSING}' AND lower({_url("s1", 1)}) IN ('http', 'https') AND contains({_sql_host("s1")}, '.')
  THEN lower({_url("s1", 1)}) || '://' || {_url("s1", 2)} || {_url("s1", 3)} || CASE WHEN {_url("s1", 4)} <> '' THEN '?' || {_url("s1", 4)} ELSE '' END ELSE '{V.MISSING}' END AS new_website FROM w1)"""
_NORMAL = f"{_C}, {_EMAIL}, {_PHONE}, {_SITE}"

# ---- scalar values ----


@registered(f"{_NORMAL} SELECT row_index, new_email AS email FROM sites")
def norm_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.companies(spark, sf_dir).select("row_index", V.email(F.col("email")).alias("email"))


@registered(f"{_NORMAL} SELECT row_index, new_phone AS phone FROM sites")
def norm_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.companies(spark, sf_dir).select("row_index", V.phone(F.col("phone")).alias("phone"))


@registered(f"{_NORMAL} SELECT row_index, new_website AS website FROM sites")
def norm_website(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.companies(spark, sf_dir).select("row_index", V.website(F.col("website")).alias("website"))


@registered(f"{_C} SELECT row_index, {_clean("company_name")} AS company_name, {_clean("email")} AS email, {_clean("siret")} AS siret FROM companies")
def clean_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.companies(spark, sf_dir).select("row_index", *[V.clean(F.col(c)).alias(c) for c in ("company_name", "email", "siret")])


@registered(f"{_C} SELECT row_index, {_present("email")} AS email, {_present("phone")} AS phone, {_present("website")} AS website FROM companies")
def missing_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.companies(spark, sf_dir).select("row_index", *[V.present(F.col(c)).alias(c) for c in V.CONTACTS])


_FLAGS = "CASE {k} % 9 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'oui' WHEN 2 THEN '0' WHEN 3 THEN 'Non' WHEN 4 THEN 'maybe' WHEN 5 THEN '' WHEN 6 THEN 'on' WHEN 7 THEN 'off' END"


@registered(f"""SELECT c_custkey, CASE WHEN f IN ('1', 'true', 'yes', 'y', 'oui', 'on') THEN true WHEN f IN ('0', 'false', 'no', 'n', 'non', 'off') THEN false ELSE false END AS flag,
  CASE WHEN f IN ('1', 'true', 'yes', 'y', 'oui', 'on') THEN true WHEN f IN ('0', 'false', 'no', 'n', 'non', 'off') THEN false ELSE true END AS flag_or_true
FROM (SELECT c_custkey, lower(trim({_FLAGS.format(k="c_custkey")})) AS f FROM customer)""")
def parse_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "customer").select("c_custkey", F.expr(_FLAGS.format(k="c_custkey")).alias("f"))
    return rows.select("c_custkey", V.boolean(F.col("f")).alias("flag"), V.boolean(F.col("f"), True).alias("flag_or_true"))


@registered("SELECT c_custkey, CAST(nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE CAST(c_custkey AS VARCHAR) || ' ' END), '') AS BIGINT) AS whole, CAST(nullif(trim(CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) || '.5' END), '') AS DOUBLE) AS part FROM customer")
def parse_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    whole, part = F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.concat(k, F.lit(" "))), F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.concat(k, F.lit(".5")))
    return _table(spark, sf_dir, "customer").select("c_custkey", V.optional_number(whole, "long").alias("whole"), V.optional_number(part, "double").alias("part"))


@registered(f"{_C} SELECT row_index, CASE WHEN length(postal_raw) < 5 THEN lpad(postal_raw, 5, '0') ELSE postal_raw END AS postal_code FROM companies")
def zero_pad_postal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.companies(spark, sf_dir).select("row_index", V.zero_padded(F.col("postal_raw"), 5).alias("postal_code"))


@registered("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(6, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0')
  WHEN p_partkey % 4 = 1 THEN lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(2, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') ELSE CAST(p_partkey AS VARCHAR) END AS cell FROM part""")
def number_format_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.when(F.col("p_partkey") % 4 == 0, "000000").when(F.col("p_partkey") % 4 == 1, '#"00"').when(F.col("p_partkey") % 4 == 2, "0.00")
    return _table(spark, sf_dir, "part").select("p_partkey", V.cell_text(F.col("p_partkey").cast("double"), form).alias("cell"))


@registered(f"{_C} SELECT row_index, {_digits("siret")} AS siret, {_valid("siret")} AS valid FROM companies")
def siret_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.companies(spark, sf_dir).select("row_index", V.digits(F.col("siret")).alias("siret"), V.has_valid_siret(F.col("siret")).alias("valid"))


# ---- schema binding ----


@registered("SELECT CAST(c_custkey + 2 AS INTEGER) AS row_index, CAST(c_custkey AS VARCHAR) AS siret, c_name AS company_name, c_mktsegment AS city, CAST(NULL AS VARCHAR) AS email, CAST(c_nationkey AS VARCHAR) AS status FROM customer")
def schema_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    s = lambda x: F.col(x).cast("string")
    odd = c.select((F.col("c_custkey") + 2).cast("int").alias("row_index"), F.lit("x").alias("Entreprise"), s("c_mktsegment").alias(" VILLE "), s("c_name").alias("Raison  Sociale"), s("c_custkey").alias("N° SIRET"), s("c_nationkey").alias("Statut enrichissement"))
    return headers.bound(odd).select("row_index", "siret", "company_name", "city", "email", "status")


# ---- eligibility ----

_SKIP = f"""CASE WHEN {_status("status")} = 'technical_error' THEN false WHEN {_status("status")} = 'invalid_input' THEN NOT ({_valid("siret")} AND {_clean("company_name")} IS NOT NULL)
  WHEN {_status("status")} IN ('success', 'not_found') THEN true ELSE {_clean("email")} IS NOT NULL AND {_clean("phone")} IS NOT NULL AND {_clean("website")} IS NOT NULL END"""


@registered(f"{_C} SELECT row_index, {_status("status")} AS status, {_SKIP} AS skipped FROM companies")
def skip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.companies(spark, sf_dir).select("row_index", eligibility.read_status(F.col("status")).alias("status"), eligibility.skip().alias("skipped"))


@registered(f"""{_C} SELECT {_status("status")} AS status, NOT ({_SKIP}) AS is_eligible, {_valid("siret")} AND {_clean("company_name")} IS NOT NULL AS processable, count(*) AS n FROM companies GROUP BY ALL""")
def enrichment_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = derived.companies(spark, sf_dir)
    flags = c.select(eligibility.read_status(F.col("status")).alias("status"), (~eligibility.skip()).alias("is_eligible"), eligibility.is_processable(F.col("siret"), F.col("company_name")).alias("processable"))
    return flags.groupBy("status", "is_eligible", "processable").agg(F.count(F.lit(1)).alias("n"))


@registered(f"{_C} SELECT row_index, siret, company_name FROM companies WHERE NOT ({_SKIP})")
def eligible_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligibility.eligible(derived.companies(spark, sf_dir)).select("row_index", "siret", "company_name")


_HOLES = "CASE WHEN row_index % 5 = 0 OR row_index > (SELECT 0.9 * max(row_index) FROM companies) THEN NULL ELSE siret END"


def _with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = derived.companies(spark, sf_dir)
    most = c.agg(F.max("row_index") * 0.9).scalar()
    return c.select("row_index", F.when((F.col("row_index") % 5 == 0) | (F.col("row_index") > most), None).otherwise(F.col("siret")).alias("siret"))


@registered(f"{_C}, holes AS (SELECT row_index, {_HOLES} AS siret FROM companies) SELECT CAST(coalesce(max(row_index), 1) AS INTEGER) AS last_useful_row FROM holes WHERE siret IS NOT NULL AND row_index >= 2")
def last_useful_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligibility.last_useful_row(_with_holes(spark, sf_dir), ("siret",))


@registered(f"{_C}, holes AS (SELECT row_index, {_HOLES} AS siret FROM companies) SELECT row_index, siret FROM holes WHERE row_index >= 10 AND row_index < 10 + 5000 AND row_index <= (SELECT max(row_index) FROM holes WHERE siret IS NOT NULL)")
def row_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligibility.row_range(_with_holes(spark, sf_dir), 10, 5000, ("siret",))


@registered(f"{_C} SELECT row_index, CAST((row_index - 2) // 100 AS BIGINT) AS batch_id FROM companies")
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligibility.in_batches(derived.companies(spark, sf_dir), 100).select("row_index", "batch_id")


@registered(f"{_C} SELECT row_index, {_clean("email")} IS NOT NULL AND {_clean("phone")} IS NOT NULL AND {_clean("website")} IS NOT NULL AS filled, coalesce({_clean("email")}, 'Non trouvé') <> 'Non trouvé' OR coalesce({_clean("phone")}, 'Non trouvé') <> 'Non trouvé' OR coalesce({_clean("website")}, 'Non trouvé') <> 'Non trouvé' AS any_contact FROM companies")
def contact_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = [F.col(c) for c in V.CONTACTS]
    return derived.companies(spark, sf_dir).select("row_index", eligibility.cells_filled(*cells).alias("filled"), eligibility.any_contact(*cells).alias("any_contact"))


@registered(f"""{_C} SELECT count(*) AS processed_rows, count(*) FILTER (status = 'success') AS success_rows, count(*) FILTER (status = 'not_found') AS not_found_rows,
  count(*) FILTER (status = 'technical_error') AS technical_error_rows, count(*) FILTER (status = 'invalid_input') AS invalid_input_rows,
  count(*) FILTER (status IN ('not_found', 'technical_error', 'invalid_input')) AS failed_rows FROM companies""")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligibility.run_counters(derived.companies(spark, sf_dir))


# ---- results, gate and merge ----

_RESULT = "CASE row_index % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'siret' WHEN 2 THEN 'name_and_address' ELSE 'name_and_city' END"


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up results for each company: the normal form of another row's pattern, some unverified."""
    c = derived.companies(spark, sf_dir)
    k = F.col("row_index").cast("string")
    return c.select(
        "row_index",
        F.when(F.col("row_index") % 3 == 0, V.MISSING).otherwise(F.concat(F.lit("new"), k, F.lit("@example.net"))).alias("email"),
        F.when(F.col("row_index") % 4 == 0, V.MISSING).otherwise(F.lit("01 02 03 04 05")).alias("phone"),
        F.when(F.col("row_index") % 7 == 0, V.MISSING).otherwise(F.concat(F.lit("https://new-"), k, F.lit(".example.net/"))).alias("website"),
        F.when(F.col("row_index") % 2 == 0, "not_found").otherwise("official_site").alias("website_type"),
        *[F.concat(F.lit("https://src.example/"), k, F.lit(f"/{c}")).alias(f"{c}_source") for c in V.CONTACTS],
        (F.col("row_index") % 6 != 0).alias("identity_verified"), F.expr(_RESULT).alias("identity_match_type"),
    )


_R = f"""{_C}, r0 AS (SELECT row_index, CASE WHEN row_index % 3 = 0 THEN 'Non trouvé' ELSE concat('new', row_index, '@example.net') END AS e, CASE WHEN row_index % 4 = 0 THEN 'Non trouvé' ELSE '01 02 03 04 05' END AS p,
  CASE WHEN row_index % 7 = 0 THEN 'Non trouvé' ELSE concat('https://new-', row_index, '.example.net/') END AS w, CASE WHEN row_index % 2 = 0 THEN 'not_found' ELSE 'official_site' END AS wt,
  row_index % 6 <> 0 AND {_RESULT} <> 'none' AS ok, {_RESULT} AS mt FROM companies),
r AS (SELECT row_index, CASE WHEN ok THEN e ELSE 'Non trouvé' END AS r_email, CASE WHEN ok THEN p ELSE 'Non trouvé' END AS r_phone, CASE WHEN ok THEN w ELSE 'Non trouvé' END AS r_website, wt, ok, mt FROM r0)"""


@registered(f"""{_R} SELECT row_index, r_email AS email, r_phone AS phone, r_website AS website, CASE WHEN r_website = 'Non trouvé' THEN 'not_found' WHEN wt = 'not_found' THEN 'unknown' ELSE wt END AS website_type,
  CASE WHEN r_email = 'Non trouvé' THEN 'Non trouvé' ELSE concat('https://src.example/', row_index, '/email') END AS email_source, ok AS identity_verified, CASE WHEN ok THEN mt ELSE 'none' END AS identity_match_type FROM r""")
def identity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.identity_gate(_results(spark, sf_dir)).select("row_index", *V.CONTACTS, "website_type", "email_source", "identity_verified", "identity_match_type")


def _merge_sql(over: bool) -> str:
    contact = " OR ".join(f"coalesce({_clean('c.' + c)}, 'Non trouvé') <> 'Non trouvé'" for c in V.CONTACTS)
    put = lambda c: f"CASE WHEN r.row_index IS NOT NULL AND ({str(over).lower()} OR coalesce({_clean('c.' + c)}, 'Non trouvé') = 'Non trouvé') THEN r_{c} ELSE c.{c} END AS {c}"
    status = f"CASE WHEN r.row_index IS NULL THEN c.status WHEN ({str(not over).lower()} AND ({contact})) OR r_email <> 'Non trouvé' OR r_phone <> 'Non trouvé' OR r_website <> 'Non trouvé' THEN 'success' ELSE 'not_found' END"
    return f"{_R} SELECT c.row_index, {put('email')}, {put('phone')}, {put('website')}, {status} AS status FROM companies c LEFT JOIN r ON c.row_index = r.row_index AND r.row_index % 10 <> 1"


def _merged(spark: SparkSession, sf_dir: str, over: bool) -> DataFrame:
    new = merge.identity_gate(_results(spark, sf_dir)).filter("row_index % 10 <> 1").select("row_index", *V.CONTACTS)
    return merge.merge(derived.companies(spark, sf_dir), new, over).select("row_index", *V.CONTACTS, "status")


@registered(_merge_sql(False))
def contact_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, False)


@registered(_merge_sql(True))
def contact_merge_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, True)


@registered("""SELECT o_orderkey, array_to_string(list_slice(list_distinct_ordered, 1, 30), ' ') AS sources FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ['https://b.example/' || (o_orderkey % 4)] WHEN o_orderkey % 3 = 1 THEN ['https://a.example/', 'https://c.example/' || o_orderkey, 'https://b.example/' || (o_orderkey % 4)]
    WHEN o_orderkey % 4 = 3 THEN ['https://a.example/', 'https://b.example/3'] ELSE ['https://a.example/', 'https://b.example/' || (o_orderkey % 4)] END AS list_distinct_ordered FROM orders)""")
def merge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.concat(F.lit("https://b.example/"), (F.col("o_orderkey") % 4).cast("string"))
    cell = F.when(F.col("o_orderkey") % 3 == 0, "{}").when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit('["https://a.example/", " https://c.example/'), F.col("o_orderkey").cast("string"), F.lit('"]'))).otherwise("https://a.example/\n \n")
    both = V.union_distinct(V.source_list(cell), F.array(b, b))
    return _table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(both, " ").alias("sources"))


@registered(f"""{_C} SELECT row_index, CASE WHEN coalesce({_clean("email")}, 'Non trouvé') <> 'Non trouvé' OR coalesce({_clean("phone")}, 'Non trouvé') <> 'Non trouvé' OR coalesce({_clean("website")}, 'Non trouvé') <> 'Non trouvé' OR row_index % 2 = 0 THEN 'success' ELSE 'not_found' END AS kept,
  CASE WHEN row_index % 2 = 0 THEN 'success' ELSE 'not_found' END AS overwritten FROM companies""")
def result_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    some, found = eligibility.any_contact(*[F.col(c) for c in V.CONTACTS]), F.col("row_index") % 2 == 0
    return derived.companies(spark, sf_dir).select("row_index", merge.result_status(some, found, F.lit(False)).alias("kept"), merge.result_status(some, found, F.lit(True)).alias("overwritten"))


# ---- addresses and pages ----


@registered(f"SELECT page_id, lower({_url('url', 1)}) || '://' || lower({_url('url', 2)}) || CASE WHEN {_url('url', 3)} = '' THEN '/' ELSE {_url('url', 3)} END || CASE WHEN {_url('url', 4)} <> '' THEN '?' || {_url('url', 4)} ELSE '' END AS url FROM pages")
def canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", V.canonical_url(F.col("url")).alias("url"))


@registered(f"SELECT page_id, {_bare_host('url')} AS host FROM pages")
def url_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", V.url_host(F.col("url")).alias("host"))


@registered(f"SELECT page_id, {_url('url', 1)} || '://' || {_url('url', 2)} || '/' AS origin FROM pages")
def url_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", V.url_origin(F.col("url")).alias("origin"))


_ODD_URL = "CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN concat('https://user:pw@', substr(url, 9)) WHEN 2 THEN 'http://localhost/x' WHEN 3 THEN 'https://printer.local:443/' WHEN 4 THEN 'https://example.com:8443/' ELSE 'ftp://example.com/' END"


@registered(rf"""SELECT page_id, {_url('u', 1)} IN ('http', 'https') AND NOT contains({_url('u', 2)}, '@') AND regexp_extract({_url('u', 2)}, ':([0-9]*)$', 1) IN ('', '80', '443')
  AND NOT ({_sql_host('u')} IN ('', 'localhost', 'localhost.localdomain') OR ends_with({_sql_host('u')}, '.local') OR ends_with({_sql_host('u')}, '.internal')) AS is_public FROM (SELECT page_id, {_ODD_URL} AS u FROM pages)""")
def public_url_syntax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", V.is_public_syntax(F.expr(_ODD_URL)).alias("is_public"))


@registered(rf"SELECT page_id, {_url('url', 3)} IN ('', '/') AS on_root, list_has_any(string_split(trim(regexp_replace(lower({_url('url', 3)}), '[^a-z0-9]+', ' ', 'g')), ' '), ['fr', 'en']) AS has_word FROM pages")
def page_path_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select("page_id", identity.on_root(url).alias("on_root"), T.has_word(identity.path_key(url), ("fr", "en")).alias("has_word"))


@registered("""SELECT page_id, CAST(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS INTEGER) AS n_links, array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), ' ') AS hrefs FROM pages""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = pages.parse(_dealt(spark, sf_dir, "pages")).select("page_id", "links")
    return links.select("page_id", F.size("links").alias("n_links"), F.array_join(F.transform("links", lambda x: x["href"]), " ").alias("hrefs"))


@registered("""SELECT page_id, 'body' AS region, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS h FROM pages) GROUP BY page_id""")
def link_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = pages.parse(_dealt(spark, sf_dir, "pages")).select("page_id", F.explode("links").alias("x"))
    return links.groupBy("page_id", F.col("x.region").alias("region")).agg(F.count(F.lit(1)).alias("n"))


@registered("""SELECT page_id, count(*) AS n, count(*) FILTER (h IN ('/contact', '/tel', '/email')) AS contact FROM (SELECT page_id, lower(unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1))) AS h FROM pages) GROUP BY page_id""")
def link_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = pages.parse(_dealt(spark, sf_dir, "pages")).select("page_id", F.explode("links").alias("x"))
    return links.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x.contact")).alias("contact"))


@registered()
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shown text needs an HTML parser; tests/test_pages.py holds it against pages written by hand."""
    return pages.parse(_dealt(spark, sf_dir, "pages")).select("page_id", "text", "legal_popup", F.size("candidates").alias("n_candidates"))


# ---- texts ----

_MAIL = r"(?i)[A-Z0-9.!#$%&''*+/=?^_`{|}~-]+@[A-Z0-9.-]+\.[A-Z]{2,63}"


@registered(rf"SELECT doc_id, CAST(len(m) AS INTEGER) AS n, array_to_string(m, ' ') AS emails FROM (SELECT doc_id, regexp_extract_all(text, '{_MAIL}') AS m FROM documents)")
def email_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.transform(pages.scanned_emails(F.col("text")), lambda x: x["raw"])
    return _dealt(spark, sf_dir, "documents").select("doc_id", F.size(found).alias("n"), F.array_join(found, " ").alias("emails"))


_KEY = r"trim(regexp_replace(replace(lower(strip_accents(text)), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))"


@registered(f"SELECT doc_id, {_KEY} AS search_key FROM documents")
def text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dealt(spark, sf_dir, "documents").select("doc_id", T.search_key(F.col("text")).alias("search_key"))


@registered(f"SELECT doc_id, list_has_any(string_split(k, ' '), ['trash', 'contact', 'tel', 'token']) OR contains(k, 'of the') AS has_word FROM (SELECT doc_id, {_KEY} AS k FROM documents)")
def keyword_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dealt(spark, sf_dir, "documents").select("doc_id", T.has_word(T.search_key(F.col("text")), ("trash", "contact", "tel", "token", "of the")).alias("has_word"))


@registered("SELECT doc_id, place, substr(text, greatest(1, place - 300), CASE WHEN place > 300 THEN 600 ELSE place - 1 + 300 END) AS context FROM (SELECT doc_id, text, CAST(strpos(text, 'the') AS INTEGER) AS place FROM documents) WHERE place > 0")
def context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "documents").withColumn("place", F.locate("the", "text")).filter("place > 0")
    start = F.greatest(F.lit(1), F.col("place") - pages.CONTEXT)
    return d.select("doc_id", "place", F.substring("text", start, F.col("place") + pages.CONTEXT - start).alias("context"))


# ---- identity, scores, candidates on made-up rows ----

_CANDIDATES = """
SELECT CAST(c_custkey AS BIGINT) AS id, CAST(c_custkey % 300 AS INT) AS row_index, CASE WHEN c_custkey % 2 = 0 THEN 'email' ELSE 'phone' END AS field,
  CASE c_custkey % 7 WHEN 0 THEN 'mailto' WHEN 1 THEN 'tel_link' WHEN 2 THEN 'visible_text' WHEN 3 THEN 'json_ld' WHEN 4 THEN 'reversed_mailto' WHEN 5 THEN 'reversed_visible_text' ELSE 'guess' END AS method,
  concat(CASE WHEN c_custkey % 3 = 0 THEN concat('atelier ', CAST(c_custkey % 300 AS STRING), ' ') ELSE '' END, CASE WHEN c_custkey % 4 = 0 THEN 'ville 69001 ' ELSE '' END, CASE WHEN c_custkey % 5 < 2 THEN 'contact' ELSE 'accueil' END, CASE WHEN c_custkey % 11 = 0 THEN ' service client' ELSE '' END) AS context_key,
  c_custkey % 2 = 0 AS header, concat('https://www.site', CAST(c_custkey % 300 AS STRING), '.example', CASE c_custkey % 3 WHEN 0 THEN '/' WHEN 1 THEN '/mentions-legales' ELSE '/produits/liste' END) AS url,
  CASE c_custkey % 6 WHEN 0 THEN 'siret' WHEN 1 THEN 'none' ELSE 'name_and_city' END AS match_type, concat('atelier', CAST(c_custkey % 300 AS STRING)) AS name_key, 'ville' AS city_key, '69001' AS postal_code_key,
  CAST(c_custkey % 4 AS INT) AS page_no, CAST(c_custkey % 13 AS INT) AS ordinal, concat(CASE WHEN c_custkey % 5 = 0 THEN 'Info' ELSE 'info' END, CAST(c_custkey % 40 AS STRING), '@site', CAST(c_custkey % 300 AS STRING), '.example') AS value,
  c_custkey % 9 = 0 AS conflicting, c_custkey % 10 < 5 AS identity_verified, c_custkey % 3 > 0 AS name_matches
FROM {customer}
"""
_K = f"WITH cand AS ({_CANDIDATES.format(customer='customer')})"
_SCORE = """CASE method WHEN 'mailto' THEN 45 WHEN 'reversed_mailto' THEN 50 WHEN 'tel_link' THEN 45 WHEN 'visible_text' THEN 25 WHEN 'reversed_visible_text' THEN 30 WHEN 'json_ld' THEN 55 ELSE 20 END
  + CASE WHEN contains(replace(context_key, ' ', ''), name_key) THEN 25 ELSE 0 END + CASE WHEN contains(context_key, 'ville') OR contains(context_key, '69001') THEN 15 ELSE 0 END
  + CASE WHEN contains(context_key, 'contact') THEN 15 ELSE 0 END + CASE WHEN url LIKE '%/mentions-legales' THEN 10 ELSE 0 END + CASE WHEN url LIKE '%.example/' THEN 10 ELSE 0 END
  + CASE WHEN match_type = 'siret' THEN 5 ELSE 0 END - CASE WHEN header AND contains(context_key, 'service client') THEN 50 ELSE 0 END"""


def _cands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_CANDIDATES, customer=_table(spark, sf_dir, "customer"))


@registered(f"{_K} SELECT id, CAST({_SCORE} AS INTEGER) AS score FROM cand")
def candidate_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cands(spark, sf_dir).select("id", identity.score().alias("score"))


@registered(f"{_K} SELECT row_index, field, ordinal, value, method, id FROM (SELECT *, row_number() OVER (PARTITION BY row_index, field, lower(value) ORDER BY ordinal, value, method, id) AS rn FROM cand) WHERE rn = 1")
def candidate_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _cands(spark, sf_dir).select("row_index", "field", "ordinal", "value", "method", "id")
    return pages.first_of_equals(rows, ["row_index"])


@registered(f"""{_K}, s AS (SELECT *, {_SCORE} AS score FROM cand) SELECT row_index, field, value, url, method, CAST(score AS INTEGER) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY row_index, field ORDER BY score DESC, length(url), page_no, ordinal, value, url, method) AS rn FROM s WHERE score >= 65) WHERE rn = 1""")
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.best(_cands(spark, sf_dir).withColumn("score", identity.score()), ["row_index"])


_VERIFIED = "bool_or(match_type = 'siret' AND (url LIKE '%/mentions-legales' OR (url LIKE '%.example/' AND name_matches AND NOT conflicting)))"


@registered(f"{_K} SELECT row_index, {_VERIFIED} AS site_verified FROM cand GROUP BY row_index")
def site_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.site_verified(_cands(spark, sf_dir).withColumn("location_matches", ~F.col("conflicting")), ["row_index"])


@registered(f"{_K}, v AS (SELECT row_index AS r, {_VERIFIED} AS site_verified FROM cand GROUP BY row_index) SELECT id, NOT conflicting AND (match_type <> 'none' OR site_verified OR (identity_verified AND name_matches)) AS is_eligible FROM cand JOIN v ON row_index = r")
def candidate_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cands(spark, sf_dir)
    v = identity.site_verified(c.withColumn("location_matches", ~F.col("conflicting")), ["row_index"])
    return c.join(v, "row_index").select("id", identity.is_eligible().alias("is_eligible"))


_PAGES = """
SELECT CAST(c_custkey AS BIGINT) AS id, concat(CASE WHEN c_custkey % 2 = 0 THEN concat('atelier ', CAST(c_custkey AS STRING)) ELSE 'autre maison' END, ' 12 quai des fleurs ', CASE WHEN c_custkey % 3 = 0 THEN '69001 ' ELSE '' END, CASE WHEN c_custkey % 5 = 0 THEN 'lyon' ELSE 'paris' END) AS text_key,
  concat('atelier', CAST(c_custkey AS STRING)) AS name_key, CASE c_custkey % 4 WHEN 0 THEN '12 quai des fleurs' WHEN 1 THEN 'rue de la' WHEN 2 THEN '14 quai des arbres' ELSE '12 avenue' END AS address_key,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '69001' END AS postal_code_key, 'lyon' AS city_key, CAST(10000000000000 + c_custkey AS STRING) AS siret_digits,
  CASE c_custkey % 6 WHEN 0 THEN CAST(10000000000000 + c_custkey AS STRING) WHEN 1 THEN substr(CAST(10000000000000 + c_custkey AS STRING), 1, 9) WHEN 2 THEN '99999999999999' END AS number,
  CASE WHEN c_custkey % 4 < 2 THEN concat('atelier ', CAST(c_custkey AS STRING)) ELSE 'siret' END AS number_key
FROM {customer}
"""
_P = f"WITH pg AS ({_PAGES.format(customer='customer')})"
_ADDRESS = """CASE id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN id = 14 ELSE true END AND (postal_code_key = '' OR contains(text_key, postal_code_key))"""


def _page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(_PAGES, customer=_table(spark, sf_dir, "customer"))
    one = F.array(F.struct(F.col("number").alias("value"), F.col("number_key").alias("context_key")))
    return rows.withColumn("identifiers", F.when(F.col("number").isNotNull(), one).otherwise(F.filter(one, lambda x: F.lit(False))))


@registered(f"{_P} SELECT id, {_ADDRESS} AS matches FROM pg")
def address_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_rows(spark, sf_dir).select("id", identity.address_matches(F.col("text_key"), F.col("address_key"), F.col("postal_code_key")).alias("matches"))


@registered(f"""{_P}, m AS (SELECT *, coalesce(number IN (siret_digits, substr(siret_digits, 1, 9)), false) AS exact, length(name_key) >= 4 AND contains(replace(text_key, ' ', ''), name_key) AS named, {_ADDRESS} AS addressed, contains(text_key, 'lyon') AS placed FROM pg)
SELECT id, CASE WHEN exact THEN 'siret' WHEN named AND addressed THEN 'name_and_address' WHEN named AND placed THEN 'name_and_city' ELSE 'none' END AS match_type, named AS name_matches, addressed OR placed AS location_matches,
  NOT exact AND coalesce(number NOT IN (siret_digits, substr(siret_digits, 1, 9)), false) AND contains(replace(number_key, ' ', ''), name_key) AS conflicting FROM m""")
def identity_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.page_identity(_page_rows(spark, sf_dir)).select("id", "match_type", "name_matches", "location_matches", "conflicting")


_MAILS = "CASE c_custkey % 4 WHEN 0 THEN reverse(concat('info', CAST(c_custkey AS STRING), '@example.fr')) WHEN 1 THEN concat('info', CAST(c_custkey AS STRING), '@example.fr') WHEN 2 THEN concat('a', CAST(c_custkey AS STRING), '@example.museum') ELSE 'moc' END"


@registered("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN concat('info', CAST(c_custkey AS VARCHAR), '@example.fr') WHEN 1 THEN concat('info', CAST(c_custkey AS VARCHAR), '@example.fr') WHEN 2 THEN concat('a', CAST(c_custkey AS VARCHAR), '@example.museum') ELSE 'Non trouvé' END AS email, c_custkey % 4 = 0 AS was_reversed FROM customer""")
def reversed_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(_MAILS)
    return _table(spark, sf_dir, "customer").select("c_custkey", pages.decoded_email(raw).alias("email"), pages.was_reversed(raw).alias("was_reversed"))


_LEGAL = "concat('SIRET : ', substr(CAST(10000000000000 + c_custkey AS STRING), 1, 9), ' ', substr(CAST(10000000000000 + c_custkey AS STRING), 10, 5), CASE WHEN c_custkey % 2 = 0 THEN concat('. TVA intracommunautaire FR 42 ', CAST(900000000 + c_custkey AS STRING)) ELSE '. Siren 12345' END)"


@registered("SELECT c_custkey, concat(CAST(10000000000000 + c_custkey AS VARCHAR), CASE WHEN c_custkey % 2 = 0 THEN concat(' ', CAST(900000000 + c_custkey AS VARCHAR)) ELSE '' END) AS numbers FROM customer")
def identifier_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _table(spark, sf_dir, "customer").select("c_custkey", F.lit("https://example.fr/").alias("url"), F.concat(F.lit("<p>"), F.expr(_LEGAL), F.lit("</p>")).alias("html"))
    return pages.parse(made).select("c_custkey", F.array_join(F.transform("identifiers", lambda x: x["value"]), " ").alias("numbers"))


# ---- journal ----

_J = f"""WITH companies AS ({derived.for_duckdb(derived.COMPANIES)}), journal AS ({derived.for_duckdb(derived.JOURNAL)})"""


@registered(f"""{_J}, s AS (SELECT row_index AS r, arg_max(status, line_no) AS last_status FROM journal GROUP BY row_index)
SELECT row_index, coalesce(last_status, status) AS status FROM companies LEFT JOIN s ON row_index = r""")
def journal_replay_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal.replay(derived.companies(spark, sf_dir), derived.journal(spark, sf_dir)).select("row_index", "status")


@registered(f"""{_J}, reset AS (SELECT row_index AS r, max(line_no) AS restart FROM journal WHERE has_result AND overwrite_existing GROUP BY row_index),
since AS (SELECT j.*, restart FROM journal j LEFT JOIN reset ON j.row_index = r WHERE has_result AND (restart IS NULL OR line_no >= restart)),
f AS (SELECT row_index AS r, max(restart) AS restart, max(CASE WHEN line_no = restart THEN email END) AS base, arg_min(email, line_no) FILTER (email <> 'Non trouvé') AS later FROM since GROUP BY row_index)
SELECT row_index, CASE WHEN r IS NULL THEN email WHEN restart IS NOT NULL THEN CASE WHEN base <> 'Non trouvé' THEN base ELSE coalesce(later, 'Non trouvé') END
  WHEN coalesce({_clean("email")}, 'Non trouvé') <> 'Non trouvé' THEN email ELSE coalesce(later, 'Non trouvé') END AS email FROM companies LEFT JOIN f ON row_index = r""")
def journal_replay_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal.replay(derived.companies(spark, sf_dir), derived.journal(spark, sf_dir)).select("row_index", "email")


@registered(f"{_J} SELECT line_no, j.row_index FROM journal j LEFT JOIN companies c ON j.row_index = c.row_index WHERE c.row_index IS NULL OR j.row_index % 10 = 3 OR (j.row_index % 10 = 4 AND c.company_name <> '')")
def journal_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = derived.companies(spark, sf_dir)
    known = c.select("row_index", "siret", "company_name")
    j = derived.journal(spark, sf_dir).join(known, "row_index", "left")
    j = j.withColumn("siret", F.when(F.col("row_index") % 10 == 3, F.concat(F.coalesce("siret", F.lit("")), F.lit("1"))).otherwise(F.coalesce("siret", F.lit(""))))
    j = j.withColumn("company_name", F.when(F.col("row_index") % 10 == 4, "").otherwise(F.upper(F.coalesce("company_name", F.lit("")))))
    return journal.mismatches(j, c).select("line_no", "row_index")


# ---- answers ----

_ANSWERS = """
SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_orderkey % 1000 AS INT) AS row_index, concat('{{"id":"r', CAST(o_orderkey AS STRING), '","status":"', CASE WHEN o_orderkey % 9 = 0 THEN 'incomplete","incomplete_details":{{"reason":"max_output_tokens"}}' ELSE 'completed"' END,
  ',"usage":{{"input_tokens":', CAST(100 + o_orderkey % 900 AS STRING), ',"output_tokens":', CASE WHEN o_orderkey % 5 = 0 THEN '"many"' WHEN o_orderkey % 5 = 1 THEN '-3' ELSE '40' END, ',"total_tokens":', CASE WHEN o_orderkey % 2 = 0 THEN '0' ELSE '777' END,
  '}},"output":[{{"type":"web_search_call","action":{{"type":"search","sources":[{{"type":"url","url":" https://a.example/', CAST(o_orderkey % 4 AS STRING), ' "}},{{"url":"https://b.example/"}}]}}}},',
  CASE WHEN o_orderkey % 3 = 0 THEN '{{"type":"web_search_call"}},' ELSE '{{"type":"web_search_call","action":{{"type":"open_page"}}}},' END,
  '{{"type":"message","content":[{{"text":"{{\\"email\\": \\"x', CAST(o_orderkey AS STRING), '@example.com\\"}}","annotations":[{{"url_citation":{{"url":"https://c.example/', CAST(o_orderkey % 4 AS STRING), '"}}}},{{"url":"https://b.example/"}}]}}]}}]}}') AS raw
FROM {orders}
"""


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    _dealt(spark, sf_dir, "orders").createOrReplaceTempView("siftline_orders")
    return spark.sql(_ANSWERS.format(orders="siftline_orders").replace('\\"', '\\\\"'))


@registered("""SELECT o_orderkey AS id, 100 + o_orderkey % 900 AS input_tokens, CAST(CASE WHEN o_orderkey % 5 < 2 THEN 0 ELSE 40 END AS BIGINT) AS output_tokens,
  CAST(CASE WHEN o_orderkey % 2 = 0 THEN 100 + o_orderkey % 900 + CASE WHEN o_orderkey % 5 < 2 THEN 0 ELSE 40 END ELSE 777 END AS BIGINT) AS total_tokens FROM orders""")
def response_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("id", *[c.alias(n) for n, c in responses.usage(F.col("raw")).items()])


@registered("SELECT o_orderkey AS id, concat('r', o_orderkey) AS response_id, '' AS model_snapshot FROM orders")
def response_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("id", *[c.alias(n) for n, c in responses.origin(F.col("raw")).items()])


@registered("""SELECT CAST(o_orderkey % 1000 AS INTEGER) AS row_index, CAST(sum(100 + o_orderkey % 900) AS BIGINT) AS input_tokens, CAST(sum(CASE WHEN o_orderkey % 5 < 2 THEN 0 ELSE 40 END) AS BIGINT) AS output_tokens,
  CAST(sum(CASE WHEN o_orderkey % 2 = 0 THEN 100 + o_orderkey % 900 + CASE WHEN o_orderkey % 5 < 2 THEN 0 ELSE 40 END ELSE 777 END) AS BIGINT) AS total_tokens FROM orders GROUP BY 1""")
def usage_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.usage_by_row(_answers(spark, sf_dir))


@registered("SELECT o_orderkey AS id, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS calls, o_orderkey % 9 = 0 AS cut_off FROM orders")
def search_call_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("id", responses.search_calls(F.col("raw")).alias("calls"), responses.is_cut_off(F.col("raw")).alias("cut_off"))


@registered("SELECT o_orderkey AS id, concat('https://a.example/', o_orderkey % 4, ' https://b.example/ https://c.example/', o_orderkey % 4) AS sources FROM orders")
def response_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("id", F.array_join(responses.sources(F.col("raw")), " ").alias("sources"))


@registered("""SELECT o_orderkey AS id, CAST(a AS INTEGER) AS attempt, CASE WHEN k = 1 AND a = 1 THEN 1200 WHEN k = 2 AND a = 3 THEN 2400 WHEN k = 2 AND a IN (1, 2) OR k = 3 AND a = 1 OR k = 4 AND a = 1 THEN 1200 ELSE 600 END AS cap
FROM (SELECT o_orderkey, o_orderkey % 5 AS k, unnest(range([1, 2, 4, 2, 2][o_orderkey % 5 + 1])) AS a FROM orders)""")
def call_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of a provider whose answers are whole, cut off once or always, of an unknown kind or without an object."""

    def provider(request: str, key: str) -> str:
        body = json.loads(request)
        k, cap = int(body["input"]) % 5, body["max_output_tokens"]
        if k == 2 or (k == 1 and cap < 1200):
            return json.dumps({"cap": cap, "status": "incomplete", "incomplete_details": {"reason": "max_output_tokens"}})
        text = {3: '{"website_type": "castle"}' if cap < 1200 else '{"email": "a@b.fr"}', 4: "none" if cap < 1200 else "{}"}.get(k, '{"email": "a@b.fr"}')
        return json.dumps({"cap": cap, "output_text": text})

    key = F.col("o_orderkey")
    asked = _dealt(spark, sf_dir, "orders").select(key.cast("int").alias("row_index"), F.to_json(F.struct(key.cast("string").alias("input"), F.lit(600).alias("max_output_tokens"))).alias("request"))
    got = responses.call(asked, lambda: provider, wait_s=0)
    return got.select(F.col("row_index").cast("long").alias("id"), "attempt", F.get_json_object("raw", "$.cap").cast("int").alias("cap"))


@registered("""SELECT o_orderkey AS id, concat('{"email": "x', o_orderkey, '@example.com"}') AS answer FROM orders""")
def answer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("id", responses.answer_text(F.col("raw")).alias("answer"))


@registered("""SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN concat('{"a": "} ', o_orderkey, '"}') WHEN 1 THEN '{"b": {"c": 1}}' END AS found FROM orders""")
def embedded_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, F.concat(F.lit('Sure: {"a": "} '), k.cast("string"), F.lit('"} and {"x": 2}'))).when(k % 3 == 1, 'x {"b": {"c": 1}}').otherwise("{ open")
    return _table(spark, sf_dir, "orders").select(k.alias("id"), responses.embedded_object(text).alias("found"))


@registered("""SELECT o_orderkey AS id, CASE WHEN proven AND o_orderkey % 2 = 0 THEN 'a@example.com' ELSE 'Non trouvé' END AS email, CASE WHEN proven THEN '01 02 03 04 05' ELSE 'Non trouvé' END AS phone, proven AS identity_verified, CASE WHEN proven THEN 'siret' ELSE 'none' END AS identity_match_type
FROM (SELECT o_orderkey, o_orderkey % 5 <> 0 AS proven FROM orders)""")
def evidence_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    seen = "https://seen.example/page"
    made = _table(spark, sf_dir, "orders").select(
        k.alias("id"), F.lit("a@example.com").alias("email"), F.lit("0102030405").alias("phone"), F.lit("https://seen.example").alias("website"), F.lit("official_site").alias("website_type"),
        F.when(k % 2 == 0, f"{seen}#top").otherwise("https://other.example/").alias("email_source"), F.lit(f"{seen}/").alias("phone_source"), F.lit("https://nowhere.example/").alias("website_source"),
        F.when(k % 5 == 0, "https://nowhere.example/").otherwise(seen).alias("identity_source"), F.lit(True).alias("identity_verified"), F.lit("siret").alias("identity_match_type"), F.array(F.lit(seen)).alias("sources"),
    )
    return responses.evidence_policy(made).select("id", "email", "phone", "identity_verified", "identity_match_type")


# ---- evaluation ----

_FOUND = {f"{s}_{c}": f"lower({s}_{c}) <> 'non trouvé'" for s in ("baseline", "candidate") for c in V.CONTACTS}
_SITE_KEY = lambda x: rf"regexp_replace(lower(regexp_replace(regexp_replace({x}, '^https://', ''), '/+$', '')), '^www\.', '')"
_MATCH = {
    "email": f"error_type = '' AND {_FOUND['baseline_email']} AND {_FOUND['candidate_email']} AND lower(baseline_email) = lower(candidate_email)",
    "phone": f"error_type = '' AND {_FOUND['baseline_phone']} AND {_FOUND['candidate_phone']} AND {_digits('baseline_phone')} = {_digits('candidate_phone')}",
    "website": f"error_type = '' AND {_FOUND['baseline_website']} AND {_FOUND['candidate_website']} AND {_SITE_KEY('baseline_website')} = {_SITE_KEY('candidate_website')}",
}
_X = f"{_E}, x AS (SELECT *, {_MATCH['email']} AS email_exact_match, {_MATCH['phone']} AS phone_exact_match, {_MATCH['website']} AS website_exact_match FROM evals)"


@registered(f"{_X} SELECT deployment, row_index, email_exact_match, phone_exact_match, website_exact_match FROM x")
def model_eval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.compared(derived.evals(spark, sf_dir)).select("deployment", "row_index", *[f"{c}_exact_match" for c in V.CONTACTS])


def _sum3(template: str) -> str:
    return " + ".join(f"count(*) FILTER ({template.format(c=c, b=_FOUND['baseline_' + c], f=_FOUND['candidate_' + c])})" for c in V.CONTACTS)


_OK = "error_type = ''"


@registered(f"""{_X} SELECT deployment, count(*) AS requested_rows, count(*) FILTER ({_OK}) AS completed_rows, count(*) FILTER (error_type <> '') AS error_rows, count(*) FILTER (baseline_status = 'success') AS baseline_success_rows,
  count(*) FILTER ({_OK} AND candidate_status = 'success') AS candidate_success_rows, {_sum3(_OK + ' AND {b}')} AS baseline_found_fields, {_sum3(_OK + ' AND {f}')} AS candidate_found_fields,
  {_sum3(_OK + ' AND {b} AND {c}_exact_match')} AS exact_matches, round(CAST(100.0 AS DOUBLE) * ({_sum3(_OK + ' AND {b} AND {c}_exact_match')}) / ({_sum3(_OK + ' AND {b}')}), 1) AS exact_match_pct, {_sum3(_OK + ' AND {f} AND NOT ({b})')} AS new_contacts,
  CAST(sum(input_tokens) FILTER ({_OK}) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) FILTER ({_OK}) AS BIGINT) AS output_tokens, CAST(sum(total_tokens) FILTER ({_OK}) AS BIGINT) AS total_tokens,
  CAST(sum(web_search_calls) FILTER ({_OK}) AS BIGINT) AS web_search_calls, CAST(sum(deterministic_fields_found) FILTER ({_OK}) AS BIGINT) AS deterministic_fields_found,
  count(*) FILTER ({_OK} AND deterministic_fields_found > 0) AS rows_with_gain, CAST(avg(latency_seconds) FILTER ({_OK}) AS DOUBLE) AS average_latency_seconds FROM x GROUP BY deployment""")
def model_eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived.evals(spark, sf_dir).withColumn("latency_seconds", F.col("latency_seconds").cast("double"))
    return evaluate.model_summary(evaluate.compared(rows))


@registered(f"""{_E} SELECT count(*) AS requested_rows, count(*) FILTER ({_OK}) AS completed_rows, count(*) FILTER (error_type <> '') AS error_rows, count(*) FILTER ({_OK} AND deterministic_fields_found > 0) AS rows_with_gain,
  count(*) FILTER ({_OK} AND baseline_email = 'Non trouvé' AND candidate_email <> 'Non trouvé') AS recovered_emails, count(*) FILTER ({_OK} AND baseline_phone = 'Non trouvé' AND candidate_phone <> 'Non trouvé') AS recovered_phones,
  count(*) FILTER ({_OK} AND identity_extraction_method = 'site_siret_or_siren') AS site_identity_matches, count(*) FILTER ({_OK} AND legal_popup_detected) AS legal_popups_detected,
  CAST(sum(pages_fetched) FILTER ({_OK}) AS BIGINT) AS pages_fetched, CAST(avg(latency_seconds) FILTER ({_OK}) AS DOUBLE) AS average_latency_seconds FROM evals""")
def site_eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.site_summary(derived.evals(spark, sf_dir).withColumn("latency_seconds", F.col("latency_seconds").cast("double")))


@registered(f"{_C} SELECT row_index, {_digits('siret')} AS siret, {_status('status')} AS baseline_status, coalesce({_clean('email')}, 'Non trouvé') AS baseline_email FROM companies WHERE {_status('status')} IN ('success', 'not_found') AND {_valid('siret')} AND {_clean('company_name')} IS NOT NULL ORDER BY row_index LIMIT 20")
def model_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.model_references(derived.companies(spark, sf_dir), 20).select("row_index", "siret", "baseline_status", "baseline_email")


@registered(f"""{_C} SELECT row_index, {_clean('website')} AS website, 'name_and_city' AS identity_match_type FROM companies WHERE {_status('status')} = 'success' AND {_valid('siret')} AND {_clean('company_name')} IS NOT NULL
  AND coalesce({_clean('website')}, 'Non trouvé') <> 'Non trouvé' AND (coalesce({_clean('email')}, 'Non trouvé') = 'Non trouvé' OR coalesce({_clean('phone')}, 'Non trouvé') = 'Non trouvé') ORDER BY row_index LIMIT 30""")
def site_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.site_references(derived.companies(spark, sf_dir), 30).select("row_index", "website", "identity_match_type")


@registered(f"{_C}, d AS (SELECT unnest(['alpha', 'beta']) AS deployment) SELECT deployment, row_index FROM companies, d")
def deployments_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.cross_deployments(derived.companies(spark, sf_dir).select("row_index"), [" alpha", "beta", "alpha"]).select("deployment", "row_index")


# ---- evaluation reports, audit merges, contexts ----

_AUDIT_SHEET = f"""{_R}, c AS (SELECT *, CASE WHEN row_index % 3 = 0 THEN concat('https://old.example/', row_index) END AS email_source, CASE WHEN row_index % 2 = 0 THEN '["https://s.example/"]' END AS sources,
  CASE WHEN row_index % 4 = 0 THEN 'directory' END AS website_type FROM companies)"""


def _audit_sql(over: bool) -> str:
    takes = lambda c: f"({str(over).lower()} OR coalesce({_clean('c.' + c)}, 'Non trouvé') = 'Non trouvé')"
    new_type = "CASE WHEN r_website = 'Non trouvé' THEN 'not_found' WHEN wt = 'not_found' THEN 'unknown' ELSE wt END"
    both = """'["https://s.example/","https://t.example/' || r.row_index || '"]'"""
    return f"""{_AUDIT_SHEET} SELECT c.row_index,
  CASE WHEN r.row_index IS NULL THEN c.email_source WHEN {takes("email")} AND ({str(over).lower()} OR c.email_source IS NULL) THEN CASE WHEN r_email <> 'Non trouvé' THEN concat('https://src.example/', r.row_index, '/email') END ELSE c.email_source END AS email_source,
  CASE WHEN r.row_index IS NOT NULL AND {takes("website")} THEN {new_type} ELSE c.website_type END AS website_type,
  CASE WHEN r.row_index IS NULL THEN c.sources ELSE {both} END AS sources,
  CASE WHEN r.row_index IS NOT NULL THEN CAST(100 + r.row_index % 50 AS VARCHAR) ELSE '7' END AS input_tokens, CASE WHEN r.row_index IS NULL THEN 'before' WHEN r.row_index % 2 = 0 THEN 'm-2' END AS model_snapshot
FROM c LEFT JOIN r ON c.row_index = r.row_index AND r.row_index % 10 <> 1"""


def _audited(spark: SparkSession, sf_dir: str, over: bool) -> DataFrame:
    k = F.col("row_index")
    new = merge.identity_gate(_results(spark, sf_dir)).filter("row_index % 10 <> 1")
    new = new.select("row_index", *V.CONTACTS, "website_type", *[f"{c}_source" for c in V.CONTACTS], F.array(F.lit("https://s.example/"), F.concat(F.lit("https://t.example/"), k.cast("string"))).alias("sources"), (100 + k % 50).alias("input_tokens"), F.when(k % 2 == 0, "m-2").otherwise("").alias("model_snapshot"))
    sheet = derived.companies(spark, sf_dir).withColumns({
        "email_source": F.when(k % 3 == 0, F.concat(F.lit("https://old.example/"), k.cast("string"))), "sources": F.when(k % 2 == 0, '["https://s.example/"]'), "website_type": F.when(k % 4 == 0, "directory"),
        "input_tokens": F.lit("7"), "model_snapshot": F.lit("before"),
    })
    return merge.merge(sheet, new, over, True).select("row_index", "email_source", "website_type", "sources", "input_tokens", "model_snapshot")


@registered(_audit_sql(False))
def audit_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audited(spark, sf_dir, False)


@registered(_audit_sql(True))
def audit_merge_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audited(spark, sf_dir, True)


@registered("SELECT doc_id, m[1] AS address, substr(text, greatest(1, strpos(text, m[1]) - 300), least(strpos(text, m[1]) - 1, 300) + 300) AS context FROM (SELECT doc_id, text, regexp_extract_all(text, '" + _MAIL + "') AS m FROM documents) WHERE len(m) > 0")
def email_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first address of each text and what the operator says stands around it."""
    first = F.get(pages.scanned_emails(F.col("text")), F.lit(0))
    return _dealt(spark, sf_dir, "documents").select("doc_id", first.alias("x")).filter("x IS NOT NULL").select("doc_id", F.col("x.raw").alias("address"), "x.context")


_REPORT = {"sources": "'[]'", "deterministic_pages": "'[]'", "email_extraction_method": "''", "phone_extraction_method": "''", **dict.fromkeys(("identity_source", "email_source", "phone_source", "website_source"), "'Non trouvé'")}


@registered(f"""{_X}, y AS (SELECT *, row_index % 13 = 0 AS gone, CASE WHEN row_index % 13 = 0 THEN 'MissingResult' ELSE error_type END AS e FROM x) SELECT deployment, 'low' AS search_context_size, true AS audit_enabled, false AS site_extraction_enabled, row_index, '1' AS siret, 'Firm' AS company_name, baseline_status, baseline_email, baseline_phone, baseline_website,
  CASE WHEN e <> '' THEN 'technical_error' WHEN {_FOUND['candidate_email']} OR {_FOUND['candidate_phone']} OR {_FOUND['candidate_website']} THEN 'success' ELSE 'not_found' END AS candidate_status,
  {', '.join(f"CASE WHEN e <> '' THEN 'Non trouvé' ELSE candidate_{c} END AS candidate_{c}, e = '' AND {c}_exact_match AS {c}_exact_match" for c in V.CONTACTS)},
  'none' AS identity_match_type, {', '.join(f'{v} AS {c}' for c, v in _REPORT.items())}, {', '.join(f"CASE WHEN e <> '' THEN 0 ELSE {c} END AS {c}" for c in ('input_tokens', 'output_tokens', 'total_tokens', 'web_search_calls', 'deterministic_fields_found'))},
  CASE WHEN e <> '' THEN '' ELSE identity_extraction_method END AS identity_extraction_method, e = '' AND legal_popup_detected AS legal_popup_detected, CASE WHEN e <> '' THEN CAST(0 AS DOUBLE) ELSE round(CAST(latency_seconds AS DOUBLE), 3) END AS latency_seconds, e AS error_type, '' AS error_message FROM y""")
def model_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 37 columns of a model evaluation's report; some rows have no result."""
    e = derived.evals(spark, sf_dir).withColumn("latency_seconds", F.col("latency_seconds").cast("double"))
    known = e.select("deployment", "row_index", F.lit("1").alias("siret"), F.lit("Firm").alias("company_name"), "baseline_status", *[f"baseline_{c}" for c in V.CONTACTS])
    done = e.filter("row_index % 13 <> 0").withColumnsRenamed({f"candidate_{c}": c for c in V.CONTACTS}).withColumns({"error_message": F.lit(""), "siret": F.lit("1"), "company_name": F.lit("Firm")})
    done = done.drop("candidate_status", "baseline_status", *[f"baseline_{c}" for c in V.CONTACTS])
    return evaluate.model_rows(known, done, "low", True, False)


for _name, _sql_text in site_queries.ORACLES.items():
    registered(_sql_text)(getattr(site_queries, _name))


# ---- the operators under plain SQL ----


def _by_sql(spark: SparkSession, sf_dir: str, sql: str, *tables_read: str) -> DataFrame:
    sql_functions.register(spark)
    return spark.sql(sql, **{t: _dealt(spark, sf_dir, t) for t in tables_read})


@registered("""SELECT h AS href, count(DISTINCT page_id) AS pages, count(*) AS links FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS h FROM pages) GROUP BY h""")
def sql_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_sql(spark, sf_dir, "SELECT l.href, count(DISTINCT p.page_id) AS pages, count(*) AS links FROM {pages} p, LATERAL page_links(p.url, p.html) l GROUP BY l.href", "pages")


@registered(rf"SELECT doc_id, CAST(i - 1 AS INTEGER) AS place, m[i] AS address FROM (SELECT doc_id, m, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{_MAIL}') AS m FROM documents))")
def sql_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_sql(spark, sf_dir, "SELECT d.doc_id, c.place, c.raw AS address FROM {documents} d, LATERAL contacts_in(d.text) c WHERE c.field = 'email'", "documents")


@registered(f"SELECT split_part(k, ' ', 1) AS first_word, count(*) AS n FROM (SELECT {_KEY} AS k FROM documents) GROUP BY ALL HAVING count(*) > 1")
def sql_search_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_sql(spark, sf_dir, "SELECT split_part(k, ' ', 1) AS first_word, count(*) AS n FROM (SELECT search_key(text) AS k FROM {documents}) GROUP BY 1 HAVING count(*) > 1", "documents")
