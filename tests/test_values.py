import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftline.functions import search_text as T
from siftline.functions import values as V


def one(spark, f, *cells):
    return [r[0] for r in spark.createDataFrame([(c,) for c in cells], "x string").select(f(F.col("x")).alias("y")).collect()]


def test_cells(spark):
    assert one(spark, V.clean, " a  \t b ", " \u001c ", None, "") == ["a b", None, None, None]
    assert one(spark, V.present, None, " N/A", "Aucune", "Non  renseigné", "x  y") == [V.MISSING] * 4 + ["x y"]


def test_emails(spark):
    cells = ["MAILTO: Jean@Exemple.FR", "<a@b.co>;", "a@b", "a@@b.co", "a..b@c.fr", "a@-c.fr", "a@c.fr-", "x" * 65 + "@c.fr", "a b@c.fr", "a@b.cé"]
    assert one(spark, V.email, *cells) == ["jean@exemple.fr", "a@b.co"] + [V.MISSING] * 7 + ["a@b.cé"]


def test_phones(spark):
    cells = ["+33 (0)4 78 00 11 22", "0033478001122", "04.78.00.11.22 poste 5", "tel:0478001122", "+33 0478001122", "00 78 00 11 22", "478001122", "+32478001122", "٠478001122"]
    assert one(spark, V.phone, *cells) == ["04 78 00 11 22"] * 5 + [V.MISSING] * 4


def test_websites(spark):
    cells = ["Exemple.fr/A?b=1#c", "HTTPS://WWW.Ex_emple.fr", "ftp://a.fr", "localhost", "http://u:p@a.fr:80/", "http://", "a.fr?", "unknown"]
    assert one(spark, V.website, *cells) == ["https://Exemple.fr/A?b=1", "https://WWW.Ex_emple.fr", V.MISSING, V.MISSING, "http://u:p@a.fr:80/", V.MISSING, "https://a.fr", V.MISSING]
    assert one(spark, V.canonical_url, "HTTP://A.fr", "https://a.fr/b?C#d") == ["http://a.fr/", "https://a.fr/b?C"]
    assert one(spark, V.url_host, "https://www.A.fr:8080/x", "http://u@b.fr") == ["a.fr", "b.fr"]


def test_public_addresses(spark):
    cells = ["https://a.fr/x", "https://a.fr:443", "http://a.fr:8080/", "http://u@a.fr/", "https://nas.local/", "http://localhost/", "file:///etc"]
    assert one(spark, V.is_public_syntax, *cells) == [True, True, False, False, False, False, False]


def test_numbers_and_lists(spark):
    rows = spark.createDataFrame([(1234.0, "00000"), (1234.0, "General"), (0.5, "00"), (123456.0, "00000"), (7.0, '"00"0')], "n double, f string")
    assert [r[0] for r in rows.select(V.cell_text(F.col("n"), F.col("f"))).collect()] == ["01234", "1234", "0.5", "123456", "007"]
    assert one(spark, V.source_list, '["a", " ", "b "]', "a\nb\n", '{"a": 1}', None, "3") == [["a", "b"], ["a", "b"], [], [], []]
    urls = spark.createDataFrame([(["a.fr#x", "a.fr", "bad", "b.fr"],), (None,)], "x array<string>")
    assert [r[0] for r in urls.select(V.url_list(F.col("x"), 2)).collect()] == [["https://a.fr", "https://b.fr"], []]


def test_search_keys(spark):
    assert one(spark, T.search_key, "Élan & Cœur-ﬁl ß", None, "N° 12 nº") == ["elan c ur fil ss", "", "n 12 no"]
    assert one(spark, T.name_key, "sas atelier du lac sarl", "sarl", "sasha", "ei sas") == ["atelierdulac", "", "sasha", ""]
    assert one(spark, lambda k: T.has_word(k, ("tel", "nous contacter")), "le tel ici", "hotel", "pour nous contacter vite") == [True, False, True]
    assert one(spark, T.address_words, "12 rue de la paix ab") == [["12", "paix"]]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aA0@. +-:/()é #?_%3", max_size=24), min_size=1, max_size=40))
def test_normal_forms_stay(spark, cells):
    for f in (V.email, V.phone, V.website, V.clean):
        once = one(spark, f, *cells)
        assert one(spark, f, *once) == once


@pytest.mark.parametrize("field,a,b,same", [("email", "A@b.fr", "a@B.FR", True), ("phone", "04 78", "0478", True), ("website", "https://A.fr/", "https://a.fr", True), ("website", "https://a.fr", V.MISSING, False)])
def test_same_contact(spark, field, a, b, same):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(V.same_contact(field, F.col("a"), F.col("b"))).first()[0] is same
