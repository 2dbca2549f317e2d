import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from siftline.functions.values import MISSING
from siftline.operators import eligibility, journal, merge
from siftline.sources import headers, sheets


def workbook(rows, name="Clients"):
    """A small workbook: text inline, numbers with the style that pads them."""
    cells = []
    for i, row in enumerate(rows, 1):
        out = []
        for j, v in enumerate(row):
            ref = f"{chr(65 + j)}{i}"
            if isinstance(v, tuple):
                out.append(f'<c r="{ref}" s="1"><v>{v[0]}</v></c>')
            elif isinstance(v, bool):
                out.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
            elif isinstance(v, (int, float)):
                out.append(f'<c r="{ref}"><v>{v}</v></c>')
            elif v is not None:
                out.append(f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>')
        cells.append(f'<row r="{i}">{"".join(out)}</row>')
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{name}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {main}><numFmts><numFmt numFmtId="164" formatCode="00000"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{''.join(cells)}</sheetData></worksheet>")
    return data.getvalue()


def test_workbook(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook([["Numéro SIRET", None, "Dénomination", "CP"], ["123", None, " Atelier ", (1230,)], [4.5, "x", True, 7], [None, None, None, None]]))
    df = sheets.read_xlsx(spark, str(tmp_path / "a.xlsx"))
    assert df.columns == ["row_index", "Numéro SIRET", "column 2", "Dénomination", "CP"]
    assert [tuple(r) for r in sheets.text_columns(df).orderBy("row_index").collect()] == [(2, "123", None, "Atelier", "01230"), (3, "4.5", "x", "True", "7")]
    bound = headers.bound(df)
    assert [tuple(r) for r in bound.select("row_index", "siret", "postal_code", "email").orderBy("row_index").collect()] == [(2, "123", "01230", None), (3, "4.5", "7", None)]
    with pytest.raises(Exception, match="no sheet"):
        sheets.read_xlsx(spark, str(tmp_path / "a.xlsx"), "Other").collect()


def test_text_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("SIRET;Ville\n1;Lyon\n2;\n3;Nice\n")
    df = sheets.read_csv(spark, str(tmp_path / "a.csv"), ";")
    assert [tuple(r) for r in df.orderBy("row_index").collect()] == [(2, "1", "Lyon"), (3, "2", None), (4, "3", "Nice")]
    many = spark.range(1000).repartition(7)
    assert sorted(r.row_index for r in sheets.with_row_index(many).collect()) == list(range(2, 1002))
    assert sheets.with_row_index(many.limit(0)).count() == 0


def test_binding():
    b = headers.bind(["x", "Raison sociale", "  n°  siret ", "Entreprise"])
    assert b.found["company_name"] == 1 and b.found["siret"] == 2 and b.appended[0] == "email" and len(b.appended) == 25
    with pytest.raises(headers.HeaderError, match="company_name"):
        headers.bind(["SIRET"])
    with pytest.raises(headers.HeaderError, match="several"):
        headers.bind(["SIRET", "siret", "Entreprise"])


SHEET = "row_index int, siret string, company_name string, email string, phone string, website string, website_type string, status string, sources string, email_source string, phone_source string, website_source string"


def test_merge_with_audit(spark):
    sheet = spark.createDataFrame([
        (2, "1", "a", "old@a.fr", None, "https://a.fr/", None, None, '["https://s.fr"]', None, None, None),
        (3, "2", "b", MISSING, "04 78", None, None, "technical_error", None, "https://kept.fr", None, None),
        (4, "3", "c", None, None, None, None, None, None, None, None, None),
        (5, "4", "d", "x@d.fr", None, None, None, "success", None, None, None, None),
    ], SHEET)
    new = spark.createDataFrame([
        (2, "new@a.fr", "01 02 03 04 05", "https://A.fr", "official_site", ["https://s.fr", "https://t.fr"], "https://e.fr", "https://p.fr", "https://w.fr", None),
        (3, "n@b.fr", MISSING, MISSING, "not_found", [], "https://n.fr", MISSING, MISSING, None),
        (4, None, None, None, None, None, None, None, None, "technical_error"),
    ], "row_index int, email string, phone string, website string, website_type string, sources array<string>, email_source string, phone_source string, website_source string, status string")
    got = {r.row_index: r for r in merge.merge(sheet, new, audit=True).collect()}
    assert (got[2].email, got[2].phone, got[2].website, got[2].website_type, got[2].status) == ("old@a.fr", "01 02 03 04 05", "https://a.fr/", "official_site", "success")
    assert (json.loads(got[2].sources), got[2].email_source, got[2].phone_source, got[2].website_source) == (["https://s.fr", "https://t.fr"], None, "https://p.fr", "https://w.fr")
    assert (got[3].email, got[3].phone, got[3].website, got[3].email_source, got[3].status) == ("n@b.fr", "04 78", MISSING, "https://kept.fr", "success")
    assert (got[4].email, got[4].status) == (None, "technical_error") and got[5].email == "x@d.fr" and got[5].status == "success"
    over = {r.row_index: r for r in merge.merge(sheet, new, True, True).collect()}
    assert over[2].email == "new@a.fr" and over[3].website == MISSING and over[3].email_source == "https://n.fr" and json.loads(over[2].sources) == ["https://s.fr", "https://t.fr"]


def test_skip_rules(spark):
    rows = [("success", "x", "x", "x"), ("technical_error", "x", "x", "x"), ("invalid_input", None, None, None), (None, "x", MISSING, "x"), ("odd", None, "x", "x")]
    df = spark.createDataFrame([("12345678901234", "n", *r[1:], r[0]) for r in rows] + [("1", "n", None, None, None, "invalid_input")], "siret string, company_name string, email string, phone string, website string, status string")
    assert [r[0] for r in df.select(eligibility.skip()).collect()] == [True, False, False, True, False, True]
    assert not any(r[0] for r in df.select(eligibility.skip(overwrite_existing=True)).collect())


def sequential(existing, records):
    cell, status = existing, None
    for _, st, has, value, over in records:
        status = st
        if has and (over or not cell or cell == MISSING):
            cell = value
    return cell, status


def test_replay_is_what_applying_in_order_gives(spark):
    import random

    rng = random.Random(9)
    sheet, lines, want = [], [], {}
    for row in range(2, 402):
        existing = rng.choice([None, MISSING, "old@x.fr"])
        records = []
        for _ in range(rng.randrange(0, 7)):
            has = rng.random() < 0.7
            records.append((len(lines), rng.choice(["success", "not_found", "technical_error"]), has, rng.choice([MISSING, f"v{len(lines)}@x.fr"]) if has else None, rng.random() < 0.25))
            lines.append((records[-1][0], row, "1", "n", *records[-1][1:]))
        sheet.append((row, "1", "N ", existing, "before"))
        cell, status = sequential(existing, records)
        want[row] = (cell, status or "before")
    s = spark.createDataFrame(sheet, "row_index int, siret string, company_name string, email string, status string")
    j = spark.createDataFrame(lines, "line_no long, row_index int, siret string, company_name string, status string, has_result boolean, email string, overwrite_existing boolean")
    assert {r.row_index: (r.email, r.status) for r in journal.replay(s, j.repartition(5)).collect()} == want
    with pytest.raises(journal.JournalError):
        journal.replay(s, j.withColumn("siret", F.lit("2")))


def test_journal_files(spark, tmp_path):
    rec = {"seq": 1, "version": 1, "row_index": 2, "siret": "1", "company_name": "N", "result": {"email": "a@b.fr", "phone": MISSING, "website": MISSING}, "status": "success", "overwrite_existing": False}
    (tmp_path / "j.jsonl").write_text(json.dumps(rec) + "\n\n" + json.dumps(rec | {"seq": 2, "result": None, "status": "technical_error"}) + "\n")
    flat = journal.from_records(journal.read(spark, str(tmp_path / "j.jsonl")))
    sheet = spark.createDataFrame([(2, "1", "n", None, None, None, None)], "row_index int, siret string, company_name string, email string, phone string, website string, status string")
    after = journal.replay(sheet, flat).first()
    assert (after.email, after.phone, after.status) == ("a@b.fr", MISSING, "technical_error")
    journal.append(journal.read(spark, str(tmp_path / "j.jsonl")), str(tmp_path / "copy"))
    assert journal.read(spark, str(tmp_path / "copy")).count() == 2
    for bad in ('{"seq": 1, "other": 2}', "{broken"):
        (tmp_path / "bad.jsonl").write_text(bad + "\n")
        with pytest.raises(journal.JournalError):
            journal.read(spark, str(tmp_path / "bad.jsonl"))
