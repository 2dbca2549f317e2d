import json
import time

import pytest
from pyspark.sql import functions as F

from siftline.functions.values import MISSING
from siftline.operators import crawl, enrich, identity, pages

ROOT = """<html><head><script type="application/ld+json">{"@graph": [{"@type": "Shop", "email": "boutique@brasserie-du-port.fr", "address": {"telephone": "+33 5 56 00 11 22"}}]}</script>
<script type="application/ld+json">{broken</script><style>.x{}</style></head><body>
<header><a href="tel:0556999999">Service client</a></header>
<main><p>Brasserie du Port<br>Quai Louis, 33000 Bordeaux</p><svg><text>05 11 22 33 44</text></svg>
<a href="MAILTO:rf.trop-ud-eiressarb%40tcatnoc?subject=x">contact nous</a></main>
<footer><a href="/mentions" data-action="open-popup">Mentions légales</a><a href="nous-contacter.html">Nous contacter</a><a href="javascript:void(0)">Contact</a><a href="https://ailleurs.fr/contact">contact</a></footer></body></html>"""


def test_parsing():
    p = pages.parse_page("https://www.brasserie-du-port.fr/", ROOT)
    assert p["text"].split("\n")[:3] == ["Service client", "Brasserie du Port", "Quai Louis, 33000 Bordeaux"] and "11 22 33" not in p["text"]
    assert [(c["field"], c["method"], c["reversed"], c["header"]) for c in p["candidates"]] == [("email", "mailto", True, False), ("email", "json_ld", False, False), ("phone", "tel_link", False, True), ("phone", "json_ld", False, False)]
    assert p["candidates"][2]["context"].startswith("[region=header] ") and "brasserie" in p["candidates"][2]["context_key"]
    by = {x["label"]: x for x in p["links"]}
    assert by["Mentions légales"]["legal"] and by["Mentions légales"]["popup"] and p["legal_popup"]
    assert by["Nous contacter"]["target"] == "https://www.brasserie-du-port.fr/nous-contacter.html" and by["Nous contacter"]["contact"] and by["Nous contacter"]["region"] == "footer"
    assert by["Contact"]["target"] is None and by["contact"]["host"] == "ailleurs.fr"
    assert pages.parse_page("https://a.fr", None)["candidates"] == [] and pages.parse_page("https://a.fr", "<a href='http://[bad'>contact</a>")["links"][0]["target"] is None


def test_numbers():
    text = "<p>SIRET n° 123 456 789 00012</p><p>R.C.S. Lyon B 987 654 321</p><p>TVA : FR 12 111222333</p><p>siren 12345</p>"
    assert [i["value"] for i in pages.parse_page("https://a.fr", text)["identifiers"]] == ["12345678900012", "987654321", "111222333"]


def page(host="h", links=(), email=False, phone=False, url=None):
    return {"final_url": url or "https://h/", "host": host, "links": [{"target": t, "host": h, "contact": c, "legal": g} for t, h, c, g in links], "has_email": email, "has_phone": phone}


def test_walks():
    s = "https://h/"
    assert crawl.walk(s, True, True, {}, 6) == ([], [s])
    assert crawl.walk(s, True, True, {s: None}, 6) == ([], [])
    links = [("https://h/c", "h", True, False), ("https://h/l", "h", False, True), ("https://x/l", "x", False, True)]
    assert crawl.walk(s, True, False, {s: page(links=links)}, 6) == ([s], ["https://h/l", "https://h/c"])
    assert crawl.walk(s, True, False, {s: page(links=links, email=True)}, 6) == ([s], ["https://h/l"])
    assert crawl.walk(s, True, False, {s: page()}, 6) == ([s], ["https://h/contact", "https://h/nous-contacter", "https://h/contactez-nous", "https://h/mentions-legales", "https://h/mentions-legales/"])
    seen = {s: page(links=links), "https://h/l": page(host="other"), "https://h/c": page()}
    assert crawl.walk(s, True, False, seen, 6) == ([s, "https://h/c"], [])
    many = [(f"https://h/{i}", "h", False, True) for i in range(50)]
    full = {s: page(links=many)} | {f"https://h/{i}": None for i in range(50)}
    assert crawl.walk(s, False, False, full, 2) == ([s], [])
    assert crawl.walk(s, False, False, {s: page(links=many)} | {f"https://h/{i}": page() for i in range(50)}, 3)[0] == [s, "https://h/0", "https://h/1"]


COMPANIES = "row_index int, siret string, company_name string, address string, postal_code string, city string"
RESULTS = "row_index int, email string, phone string, website string, website_type string, identity_verified boolean, identity_match_type string"


def found(spark, company, result, store, **how):
    c = spark.createDataFrame([(2, *company)], COMPANIES)
    r = spark.createDataFrame([(2, *result)], RESULTS)
    p = spark.createDataFrame([(u, u, h) for u, h in store.items()], "requested string, url string, html string")
    return enrich.enrich(c, r, p, **how).first()


def test_site_fills_what_is_missing(spark):
    site = "https://www.brasserie-du-port.fr"
    store = {
        f"{site}/": ROOT,
        f"{site}/mentions": "<p>Brasserie du Port, SIRET 123 456 789 00012, 33000 Bordeaux. Téléphone : 05 56 77 88 99</p>",
        f"{site}/nous-contacter.html": "<p>Brasserie du Port Bordeaux, contact : accueil@brasserie-du-port.fr</p>",
    }
    company = ("12345678900012", "SARL Brasserie du Port", "5 quai Louis", "33000", "Bordeaux")
    got = found(spark, company, (MISSING, MISSING, "https://www.brasserie-du-port.fr", "official_site", False, "none"), store, audit=True)
    assert got.deterministic_pages == [f"{site}/", f"{site}/mentions"]
    assert (got.identity_verified, got.identity_match_type, got.identity_source, got.identity_extraction_method) == (True, "siret", f"{site}/mentions", "site_siret_or_siren")
    assert (got.email, got.email_extraction_method, got.email_source) == ("contact@brasserie-du-port.fr", "reversed_mailto", f"{site}/")
    assert (got.phone, got.phone_extraction_method) == ("05 56 77 88 99", "visible_text")
    assert got.deterministic_fields_found == 2 and got.legal_popup_detected and got.sources == got.deterministic_pages
    same = found(spark, company, ("a@b.fr", "05 00 00 00 01", site, "official_site", True, "siret"), store)
    assert same.email == "a@b.fr" and same.deterministic_pages == [] and same.deterministic_fields_found == 0
    lost = found(spark, company, (MISSING, MISSING, "https://nowhere.fr", "unknown", False, "none"), store)
    assert lost.email == MISSING and not lost.identity_verified


def test_another_companys_page_gives_nothing(spark):
    html = "<p>Garage Étoile, Siret 99988877700011, contact: garage@etoile.fr 04 11 22 33 44 Nice</p>"
    got = found(spark, ("11122233300044", "Garage Etoile", None, None, "Nice"), (MISSING, MISSING, "https://etoile.fr", "official_site", True, "name_and_city"), {"https://etoile.fr/": html})
    assert (got.email, got.phone) == (MISSING, MISSING)


def test_platform_addresses_dont_count(spark):
    ld = json.dumps({"email": "contact@annonces.fr", "name": "Garage Etoile Nice contact"})
    html = f'<script type="application/ld+json">{ld}</script><p>Garage Etoile Nice</p>'
    company = ("11122233300044", "Garage Etoile", None, None, "Nice")
    got = found(spark, company, (MISSING, "04 11 22 33 44", "https://annonces.fr/fiche/9", "directory", True, "name_and_city"), {"https://annonces.fr/fiche/9": html})
    assert got.email == MISSING
    assert found(spark, company, (MISSING, "04 11 22 33 44", "https://garage-etoile.fr/", "official_site", True, "name_and_city"), {"https://garage-etoile.fr/": html}).email == "contact@annonces.fr"


@pytest.mark.parametrize("parts", [1, 7])
def test_best_doesnt_depend_on_partitions(spark, parts):
    rows = [(i % 9, "email", f"v{i % 5}", f"https://a.fr/{'x' * (i % 3)}", "mailto", 60 + i % 11, i % 4, i) for i in range(400)]
    df = spark.createDataFrame(rows, "row_index int, field string, value string, url string, method string, score int, page_no int, ordinal int").repartition(parts)
    got = {(r.row_index, r.value, r.url, r.score) for r in identity.best(df, ["row_index"]).collect()}
    want = set()
    for k in range(9):
        _, _, value, url, _, score, _, _ = min((r for r in rows if r[0] == k and r[5] >= 65), key=lambda r: (-r[5], len(r[3]), r[6], r[7]))
        want.add((k, value, url, score))
    assert got == want
    assert identity.ranked(df, ["row_index"]).filter(F.col("rank") == 1).count() == 9


def test_hostile_pages_are_read_in_bounded_time():
    block = lambda text: f'<script type="application/ld+json">{text}</script>'
    deep = "[" * 100_000
    nested = '{"a":' * 1200 + '{"email": "deep@b.fr"}' + "}" * 1200
    parsed = pages.parse_page("https://a.fr/", block(deep) + block(nested) + block('[{"x": {"email": "in@b.fr"}, "email": "out@b.fr"}]'))
    assert [c["raw"] for c in parsed["candidates"]] in (["out@b.fr", "in@b.fr"], ["deep@b.fr", "out@b.fr", "in@b.fr"])
    began = time.perf_counter()
    many = "<header></header>" * 20_000 + "<main>" + '<a href="/x">x</a>' * 20_000
    links = pages.parse_page("https://a.fr/", many)["links"]
    assert len(links) == 20_000 and {x["region"] for x in links} == {"main"} and time.perf_counter() - began < 20


@pytest.mark.parametrize(("page", "region"), [("<main><header><a href=x>y</a>", "header"), ("<main><header></header><a href=x>y</a>", "main"), ("<header><main></header><a href=x>y</a>", "main"), ("</main><footer><footer></footer><a href=x>y</a>", "footer"), ("<main></main></main><main></main><a href=x>y</a>", "body")])
def test_innermost_open_region(page, region):
    assert [x["region"] for x in pages.parse_page("https://a.fr/", page + "</a>")["links"]] == [region]
