import os
import time
import uuid
from pathlib import Path

import pytest

from siftline.functions.values import MISSING
from siftline.operators import crawl, enrich
from siftline.operators.fetched import Fetched
from siftline.plans import cli
from siftline.sources import versions
from tests.test_pages import COMPANIES, RESULTS, ROOT

SITE = "https://www.brasserie-du-port.fr"
PAGES = {
    f"{SITE}/": ROOT,
    f"{SITE}/mentions": "<p>Brasserie du Port, SIRET 123 456 789 00012, 33000 Bordeaux. Téléphone : 05 56 77 88 99</p>",
    f"{SITE}/nous-contacter.html": "<p>Brasserie du Port Bordeaux, contact : accueil@brasserie-du-port.fr</p>",
    f"{SITE}/never-linked": "<p>unseen@brasserie-du-port.fr</p>",
}
BRASSERIE = ("12345678900012", "SARL Brasserie du Port", "5 quai Louis", "33000", "Bordeaux")


def fetcher(pages, log, moved=None):
    """Pages of a dictionary; each request leaves a file with its time and address."""
    log = str(log)

    def get(url):
        Path(f"{log}/{time.time():.6f} {uuid.uuid4().hex[:6]} {url.replace('/', '|')}").touch()
        final = (moved or {}).get(url, url)
        return (final, pages[final]) if final in pages else None

    return get


def asked(log):
    return sorted(f.split(" ")[2].replace("|", "/") for f in os.listdir(log))


@pytest.fixture
def log(tmp_path):
    (tmp_path / "log").mkdir()
    return tmp_path / "log"


def run(spark, store, companies, results, **how):
    c = spark.createDataFrame([(i + 2, *x) for i, x in enumerate(companies)], COMPANIES)
    r = spark.createDataFrame([(i + 2, *x) for i, x in enumerate(results)], RESULTS)
    return {x.row_index: x for x in enrich.enrich(c, r, store, **how).collect()}


def test_walks_fetch_what_they_ask_for(spark, tmp_path, log):
    store = Fetched(spark, str(tmp_path / "pages"), None, fetcher(PAGES, log), host_gap_s=0)
    wanting = (MISSING, MISSING, SITE, "official_site", False, "none")
    got = run(spark, store, [BRASSERIE, BRASSERIE], [wanting, wanting], audit=True)
    for g in got.values():
        assert g.deterministic_pages == [f"{SITE}/", f"{SITE}/mentions"] and g.sources == g.deterministic_pages
        assert (g.identity_match_type, g.email, g.phone, g.legal_popup_detected) == ("siret", "contact@brasserie-du-port.fr", "05 56 77 88 99", True)
    assert asked(log) == [f"{SITE}/", f"{SITE}/mentions"]  # once, for both companies
    # what was fetched stays, and absent pages aren't asked for again
    again = Fetched(spark, str(tmp_path / "pages"), None, fetcher({}, log), host_gap_s=0)
    assert run(spark, again, [BRASSERIE], [wanting])[2].email == "contact@brasserie-du-port.fr" and len(asked(log)) == 2
    lost = run(spark, again, [BRASSERIE], [(MISSING, MISSING, "https://nowhere.fr", "unknown", False, "none")])[2]
    assert lost.email == MISSING and asked(log).count("https://nowhere.fr/") == 1
    run(spark, again, [BRASSERIE], [(MISSING, MISSING, "https://nowhere.fr", "unknown", False, "none")])
    assert asked(log).count("https://nowhere.fr/") == 1


def test_several_rounds_fallbacks_and_moves(spark, tmp_path, log):
    pages = {
        "https://b.fr/": "<p>Menuiserie Blanc</p><a href='/legal'>mentions légales</a>",
        "https://b.fr/legal": "<p>Menuiserie Blanc SIRET 222 333 444 00055</p><a href='/ecrire'>nous contacter</a>",
        "https://b.fr/ecrire": "<p>Menuiserie Blanc Lille, contact : blanc@b.fr, 03 20 11 22 33</p>",
        "https://elsewhere.fr/x": "<p>Menuiserie Blanc, contact : bad@elsewhere.fr</p>",
    }
    moved = {"https://old.fr/": "https://b.fr/", "https://b.fr/nous-contacter": "https://elsewhere.fr/x"}
    store = Fetched(spark, str(tmp_path / "pages"), spark.createDataFrame([("https://b.fr/legal", "https://b.fr/legal", pages["https://b.fr/legal"])], "requested string, url string, html string"), fetcher(pages, log, moved), host_gap_s=0)
    company = ("22233344400055", "Menuiserie Blanc", None, None, "Lille")
    got = run(spark, store, [company], [(MISSING, MISSING, "https://old.fr", "official_site", False, "none")])[2]
    assert (got.email, got.phone, got.identity_source) == ("blanc@b.fr", "03 20 11 22 33", "https://b.fr/legal")
    assert got.deterministic_pages == ["https://b.fr/", "https://b.fr/legal", "https://b.fr/ecrire"]
    assert asked(log) == ["https://b.fr/contact", "https://b.fr/contactez-nous", "https://b.fr/ecrire", "https://b.fr/nous-contacter", "https://old.fr/"]  # /legal was stored


def test_requests_to_a_host_keep_their_distance(spark, tmp_path, log):
    store = Fetched(spark, str(tmp_path / "pages"), None, fetcher({}, log), concurrency=2, host_gap_s=0.3)
    urls = [f"https://{h}.fr/{i}" for h in "ab" for i in range(4)]
    assert store.facts(spark.createDataFrame([(u,) for u in urls], "url string")).count() == 0
    for h in "ab":
        times = sorted(float(f.split(" ")[0]) for f in os.listdir(log) if f"{h}.fr" in f)
        assert len(times) == 4 and min(y - x for x, y in zip(times, times[1:], strict=False)) >= 0.29
    assert {(r.requested, r.html) for r in store.pages().collect()} == {(u, None) for u in urls}


def test_a_round_that_broke_off_is_parsed_later(spark, tmp_path, log, monkeypatch):
    store = Fetched(spark, str(tmp_path / "pages"), None, fetcher(PAGES, log), host_gap_s=0)
    one = spark.createDataFrame([(f"{SITE}/",)], "url string")
    with monkeypatch.context() as m:
        m.setattr("siftline.operators.pages.parse", lambda df: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            store.facts(one)
    assert store.facts(one).count() == 1 and asked(log) == [f"{SITE}/"]


def test_stored_and_fetched_walks_agree(spark, tmp_path, log):
    starts = spark.createDataFrame([(2, f"{SITE}/", True, True), (3, f"{SITE}/mentions", True, False), (4, "https://none.fr/", True, True)], "row_index int, start string, needs_email boolean, needs_phone boolean")
    from siftline.operators import pages

    table = spark.createDataFrame([(u, u, h) for u, h in PAGES.items()], "requested string, url string, html string")
    stored = crawl.crawl(starts, crawl.page_facts(pages.parse(table))).collect()
    fetched = crawl.crawl(starts, Fetched(spark, str(tmp_path / "pages"), None, fetcher(PAGES, log), host_gap_s=0).facts).collect()
    assert sorted(map(tuple, stored)) == sorted(map(tuple, fetched)) and stored


def make_fetcher():
    return fetcher(PAGES, os.environ["TEST_FETCH_LOG"])


def make_provider():
    import json

    fields = {"email": MISSING, "phone": MISSING, "website": SITE, "website_type": "official_site", "email_source": MISSING, "phone_source": MISSING, "website_source": SITE, "identity_verified": False, "identity_match_type": "none", "identity_source": MISSING}
    return lambda request, key: json.dumps({"output_text": json.dumps(fields | {"identity_verified": True, "identity_match_type": "name_and_city", "identity_source": SITE})})


def test_enrich_fetches_from_the_command_line(spark, tmp_path, log, monkeypatch):
    monkeypatch.setenv("TEST_FETCH_LOG", str(log))
    monkeypatch.setenv("SIFTLINE_HOST_GAP_S", "0")
    (tmp_path / "c.csv").write_text("SIRET,Raison sociale,Ville\n12345678900012,SARL Brasserie du Port,Bordeaux\n")
    args = ["enrich", str(tmp_path / "c.csv"), str(tmp_path / "out"), "--provider", f"{__name__}:make_provider", "--fetch", "--fetcher", f"{__name__}:make_fetcher", "--wait-s", "0"]
    assert cli.main(args, spark) == 0
    row = versions.read(spark, str(tmp_path / "out")).first()
    assert (row["Email"], row["Telephone"], row["Enrichment Status"]) == ("contact@brasserie-du-port.fr", "05 56 77 88 99", "success")
