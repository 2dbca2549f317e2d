import json

import pytest

from siftline.operators import responses
from siftline.plans import cli
from siftline.sources import versions, web

GLOBAL, INSIDE = "93.184.216.34", "10.0.0.7"


def resolver(names):
    def resolve(host, port):
        if host not in names:
            raise OSError("unknown")
        return [(0, 0, 0, "", (a, port)) for a in names[host]]

    return resolve


@pytest.mark.parametrize("url,allowed", [("https://a.fr/x", True), ("https://b.fr/", False), ("https://mixed.fr/", False), ("https://u:p@a.fr/", False), ("https://a.fr:8080/", False), ("http://localhost/", False), ("https://x.local/", False), ("ftp://a.fr/", False), ("https://none.fr/", False), ("https://a.fr:bad/", False)])
def test_only_public_addresses(url, allowed):
    names = {"a.fr": [GLOBAL], "b.fr": [INSIDE], "mixed.fr": [GLOBAL, INSIDE], "localhost": ["127.0.0.1"], "x.local": [GLOBAL]}
    assert (web.public_address(url, resolver(names)) is not None) is allowed


def site(pages):
    def opener(url, address, timeout, max_bytes):
        assert address == GLOBAL
        if url not in pages:
            raise OSError("refused")
        return pages[url]

    return lambda url: web.fetch(url, resolver({"a.fr": [GLOBAL], "inside.fr": [INSIDE]}), opener, max_bytes=100)


def test_redirects_types_and_sizes():
    to = lambda u: web.Answer(302, {"location": u}, b"")
    html = lambda b, kind="text/html; charset=latin-1", status=200: web.Answer(status, {"content-type": kind}, b)
    get = site({
        "https://a.fr/": to("/1"), "https://a.fr/1": to("/2"), "https://a.fr/2": to("https://a.fr/3"), "https://a.fr/3": html("é".encode("latin-1")), "https://a.fr/0": to("/"),
        "https://a.fr/in": to("https://inside.fr/"), "https://a.fr/pdf": html(b"x", "application/pdf"), "https://a.fr/big": html(b"x" * 101), "https://a.fr/404": html(b"x", status=404), "https://a.fr/odd": html(b"\xff", "text/html; charset=none"),
    })
    assert get("https://a.fr/") == ("https://a.fr/3", "é")
    assert get("https://a.fr/0") is None, "four redirects"
    assert [get(f"https://a.fr/{p}") for p in ("in", "pdf", "big", "404", "gone")] == [None] * 5
    assert get("https://a.fr/odd") == ("https://a.fr/odd", "�")


def test_page_store(spark):
    urls = spark.createDataFrame([("https://a.fr/x",), ("https://a.fr/x",), ("https://a.fr/none",)], "url string")
    got = web.page_store(urls, fetcher=lambda u: (u + "#", "<p>") if u.endswith("x") else None).collect()
    assert [tuple(r) for r in got] == [("https://a.fr/x", "https://a.fr/x#", "<p>")]


def make_provider():
    fields = {"email": "a@b.fr", "phone": "0478001122", "website": "b.fr", "website_type": "official_site", "email_source": "b.fr", "phone_source": "b.fr", "website_source": "b.fr", "identity_verified": True, "identity_match_type": "siret", "identity_source": "b.fr"}
    return responses.recorded({"11111111111111": json.dumps({"output_text": json.dumps(fields)})})()


def make_any_provider():
    fields = {"email": "a@b.fr", "phone": "0478001122", "website": "b.fr", "website_type": "official_site", "email_source": "b.fr", "phone_source": "b.fr", "website_source": "b.fr", "identity_verified": True, "identity_match_type": "siret", "identity_source": "b.fr"}
    return lambda request, key: json.dumps({"output_text": json.dumps(fields)})


def test_command_line(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Numéro SIRET,Raison sociale,Ville\n11111111111111,Atelier,Lyon\n22222222222222,Moulin,Nice\n")
    out = tmp_path / "out"
    assert cli.main(["enrich", str(tmp_path / "c.csv"), str(out), "--provider", "tests.test_web_and_cli:make_provider", "--wait-s", "0"], spark) == 0
    rows = {r["Raison sociale"]: r for r in versions.read(spark, str(out)).collect()}
    assert rows["Atelier"]["Email"] == "a@b.fr" and rows["Atelier"]["Enrichment Status"] == "success" and rows["Moulin"]["Enrichment Status"] == "technical_error"
    assert versions.read(spark, str(out)).columns[1:5] == ["Numéro SIRET", "Raison sociale", "Ville", "Email"]
    with pytest.raises(ValueError, match="concurrency"):
        cli.main(["enrich", str(tmp_path / "c.csv"), str(out), "--provider", "tests.test_web_and_cli:make_provider", "--concurrency", "99"], spark)


def provider_of(deployment):
    return make_provider()


def test_evaluations_from_the_command_line(spark, tmp_path):
    row = ("1" * 14, "Atelier", "Lyon", None, "04 78 00 11 22", "https://atelier.fr/", "success")
    table = spark.createDataFrame([row], "`SIRET` string, `Raison sociale` string, `Ville` string, `Email` string, `Telephone` string, `Site Web` string, `Enrichment Status` string")
    table.write.parquet(str(tmp_path / "table"))
    spark.createDataFrame([("https://atelier.fr/", "https://atelier.fr/", "<p>Atelier, SIRET 111 111 111 11111, Lyon : atelier@exemple.fr</p>")], "requested string, url string, html string").write.parquet(str(tmp_path / "pages"))
    assert cli.main(["evaluate-sites", str(tmp_path / "table"), str(tmp_path / "sites"), "--page-store", str(tmp_path / "pages")], spark) == 0
    assert cli.main(["evaluate-models", str(tmp_path / "table"), str(tmp_path / "models"), "--provider", f"{__name__}:provider_of", "--deployment", "m"], spark) == 0
    read = lambda name: spark.read.json(str(next((tmp_path / name).glob("*.summary")))).first()
    assert read("sites").recovered_emails == 1 and read("models").requested_rows == 1
