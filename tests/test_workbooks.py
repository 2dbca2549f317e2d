import io
import zipfile

import pytest

from siftline.plans import cli
from siftline.sources import headers, sheets, workbooks

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
LETTERS = workbooks.column_letters


def cell(row, place, value, style=""):
    ref, s = f"{LETTERS(place)}{row}", f' s="{style}"' if style else ""
    if isinstance(value, int):
        return f'<c r="{ref}"{s}><v>{value}</v></c>'
    return f'<c r="{ref}"{s} t="inlineStr"><is><t>{value}</t></is></c>'


def book(sheet_xml, other="<row r=\"1\"><c r=\"A1\"><v>5</v></c></row>", active=0, extra=()):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("[Content_Types].xml", '<Types><Override PartName="/xl/calcChain.xml" ContentType="c"/><Override PartName="/xl/workbook.xml" ContentType="w"/></Types>')
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><bookViews><workbookView activeTab="{active}"/></bookViews><sheets><sheet name="Notes" sheetId="2" r:id="rId9"/><sheet name="Clients" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId9" Target="/xl/worksheets/sheet2.xml"/><Relationship Id="rId5" Target="calcChain.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="164" formatCode="00000"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", sheet_xml)
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {MAIN}><sheetData>{other}</sheetData></worksheet>")
        for name, content in extra:
            z.writestr(name, content)
    return data.getvalue()


def wide(rows=4, columns=60):
    head = ["SIRET", "Raison sociale", "Ville", "Email", *[f"Own {i}" for i in range(4, columns)]]
    out = ["".join(cell(1, i, h, "1") for i, h in enumerate(head))]
    for r in range(2, rows + 1):
        out.append("".join(cell(r, i, v, "1" if i == 5 else "") for i, v in enumerate([str(r) * 14, f"Firm {r}", "Lyon", "old@a.fr" if r == 3 else None, *range(4, columns)]) if v is not None))
    body = "".join(f'<row r="{r}" ht="20">{x}</row>' for r, x in enumerate(out, 1))
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<worksheet {MAIN} xmlns:mc="urn:x" mc:Ignorable="x14"><dimension ref="A1:BH{rows}"/><cols><col min="1" max="1" width="9"/></cols><sheetData>{body}</sheetData><conditionalFormatting sqref="A1"><x>&gt; "</x></conditionalFormatting></worksheet>'


def parts(data):
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return {n: z.read(n) for n in z.namelist()}


def test_only_set_cells_change():
    xml = wide()
    before, after = parts(book(xml)), parts(workbooks.rewritten(book(xml), "Clients", {1: {60: "Telephone"}, 2: {3: "a@b.fr", 60: "04 <&>"}, 3: {3: "new@a.fr", 2: None}, 9: {0: "late"}, 6: {1: 7, 0: True}}))
    assert {n: v for n, v in after.items() if "sheet1" not in n} == {n: v for n, v in before.items() if "sheet1" not in n}
    text = after["xl/worksheets/sheet1.xml"].decode()
    assert text.startswith('<?xml version="1.0" encoding="UTF-8"?>\n<worksheet ' + MAIN + ' xmlns:mc="urn:x" mc:Ignorable="x14"><dimension ref="A1:BI9"/><cols>') and text.endswith(xml[xml.index("</sheetData>"):])
    old = {(r, c): v for r, c, v in workbooks.workbook_cells(book(xml), "Clients")}
    new = {(r, c): v for r, c, v in workbooks.workbook_cells(workbooks.rewritten(book(xml), "Clients", {1: {60: "Telephone"}, 2: {3: "a@b.fr", 60: "04 <&>"}, 3: {3: "new@a.fr", 2: None}, 9: {0: "late"}, 6: {1: 7, 0: True}}), "Clients")}
    want = old | {(1, 60): "Telephone", (2, 3): "a@b.fr", (2, 60): "04 <&>", (3, 3): "new@a.fr", (9, 0): "late", (6, 1): "7", (6, 0): "True"}
    want.pop((3, 2))
    assert new == want and text.index('r="6"') < text.index('r="9"')
    assert text.count('<row r="2" ht="20">') == 1


@pytest.mark.parametrize("body", ["<sheetData/>", "<sheetData></sheetData>", '<sheetData><row r="2"/></sheetData>', '<sheetData><row><c t="inlineStr"><is><t>x</t></is></c></row></sheetData>'])
def test_sheets_with_little_in_them(body):
    out = workbooks.rewritten_sheet(f"<worksheet {MAIN}>{body}</worksheet>".encode(), {3: {1: "c"}, 2: {0: "a", 28: "b"}})[0]
    found = [(r, c, v) for r, c, v in workbooks.workbook_cells(book(out.decode()), "Clients")] if 'r="1"' in body or "<row>" not in body else None
    assert found in (None, [(2, 0, "a"), (2, 28, "b"), (3, 1, "c")]) and out.count(b"<row") >= 2


def test_prefixed_names_and_formulas():
    xml = '<x:worksheet xmlns:x="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><x:sheetData><x:row r="1"><x:c r="A1" s="1"><x:f>B1</x:f><x:v>1</x:v></x:c></x:row></x:sheetData></x:worksheet>'
    after = parts(workbooks.rewritten(book(xml, extra=[("xl/calcChain.xml", "<calcChain/>")]), "Clients", {1: {0: "set\x00 text"}}))
    assert after["xl/worksheets/sheet1.xml"].decode().count('<x:c r="A1" s="1" t="inlineStr"><x:is><x:t xml:space="preserve">set text</x:t></x:is></x:c>') == 1
    assert "xl/calcChain.xml" not in after and b"calcChain" not in after["[Content_Types].xml"] + after["xl/_rels/workbook.xml.rels"] and b"workbook.xml" in after["[Content_Types].xml"]


def test_active_sheet_and_workbooks_with_other_headers(spark, tmp_path):
    one = f'<worksheet {MAIN}><sheetData><row r="1">{cell(1, 0, "SIRET")}{cell(1, 1, "Entreprise")}</row><row r="3">{cell(3, 1, "A")}</row></sheetData></worksheet>'
    two = f'<worksheet {MAIN}><sheetData><row r="1">{cell(1, 0, "Nom")}</row><row r="2">{cell(2, 0, "B")}{cell(2, 3, 12, "1")}</row></sheetData></worksheet>'
    (tmp_path / "1.xlsx").write_bytes(book(one, active=1))
    (tmp_path / "2.xlsx").write_bytes(book(two, active=1))
    (tmp_path / "3.xlsx").write_bytes(book(f"<worksheet {MAIN}><sheetData><row r=\"1\">{cell(1, 0, 'Only')}</row></sheetData></worksheet>", active=1))
    got = sorted((r.path[-6:], r.row_index, r.headers, r.cells) for r in workbooks.read_workbooks(spark, str(tmp_path)).collect())
    assert got == [("1.xlsx", 3, ["SIRET", "Entreprise"], [None, "A"]), ("2.xlsx", 2, ["Nom"], ["B", None, None, "00012"]), ("3.xlsx", 1, ["Only"], ["Only"])]
    assert sheets.read_xlsx(spark, str(tmp_path / "2.xlsx")).columns == ["row_index", "Nom", "column 2", "column 3", "column 4"]
    assert sheets.read_xlsx(spark, str(tmp_path / "2.xlsx"), "Notes").columns == ["row_index", "5"]
    assert sheets.read_xlsx(spark, str(tmp_path / "3.xlsx")).columns == ["row_index", "Only"] and sheets.read_xlsx(spark, str(tmp_path / "3.xlsx")).count() == 0
    with pytest.raises(ValueError, match="several workbooks"):
        sheets.read_xlsx(spark, str(tmp_path))


def test_own_columns_and_headers_stay(spark):
    df = spark.createDataFrame([(2, "x", "1", "n", None, "y")], "row_index int, `Own a` string, `N° SIRET` string, `Entreprise` string, `E-mail` string, `Own b` string")
    names = [c for c in df.columns if c != "row_index"]
    binding = headers.bind(names)
    back = headers.restored(headers.bound(df, binding), names, binding, audit=False)
    assert back.columns == [*df.columns, "Telephone", "Site Web", "Site Web Type", "Enrichment Status"]
    assert tuple(back.first()) == (2, "x", "1", "n", None, "y", None, None, None, None)


def test_a_workbook_is_enriched_in_place(spark, tmp_path):
    path = tmp_path / "clients.xlsx"
    path.write_bytes(book(wide(), active=1).replace(b"", b""))
    before = parts(path.read_bytes())
    args = ["enrich", str(path), str(tmp_path / "out"), "--provider", "tests.test_web_and_cli:make_any_provider", "--wait-s", "0", "--workbook", str(path)]
    assert cli.main(args, spark) == 0
    after = parts(path.read_bytes())
    assert {n for n in after if after[n] != before[n]} == {"xl/worksheets/sheet1.xml"}
    cells = {(r, c): v for r, c, v in workbooks.workbook_cells(path.read_bytes(), None)}
    old = {(r, c): v for r, c, v in workbooks.workbook_cells(book(wide()), "Clients")}
    assert [cells[1, c] for c in range(60, 64)] == ["Telephone", "Site Web", "Site Web Type", "Enrichment Status"]
    assert (cells[2, 3], cells[3, 3], cells[2, 63]) == ("a@b.fr", "old@a.fr", "success")
    assert {k: v for k, v in cells.items() if k[1] < 60 and k[1] != 3} == {k: v for k, v in old.items() if k[1] != 3}
    assert [parts(p.read_bytes()) == before for p in tmp_path.glob("clients.backup.*.xlsx")] == [True]
