"""Workbooks (.xlsx) read in one pass and written back with nothing changed but the cells that are set.

A workbook is a zip of XML parts and can't be split, so one task reads or writes one workbook; its rows are bounded by
the format. Written back, every part is copied as it is but the sheet's own, and in that one only the bytes of the set
cells are replaced: styles, formulas, other sheets, drawings and columns that nobody asked about stay.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import UTC, datetime
from posixpath import join, normpath
from typing import NamedTuple
from xml.etree import ElementTree
from xml.parsers import expat
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.sources import versions

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_TAG = re.compile(rb"<(?:[^\"'>]|\"[^\"]*\"|'[^']*')*>")
_UNWRITABLE = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")
Value = str | int | bool | None


def column_number(reference: str) -> int:
    """From 0, of a cell's reference."""
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def column_letters(place: int) -> str:
    out = ""
    while place >= 0:
        place, letter = place // 26 - 1, place % 26
        out = chr(65 + letter) + out
    return out


def sheet_part(z: zipfile.ZipFile, sheet: str | None) -> str:
    """The part that holds a sheet: the named one, else the one that was active when the workbook was saved."""
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    sheets = {s.get("name"): s.get(_REL) for s in book.iter(f"{_MAIN}sheet")}
    if sheet is not None and sheet not in sheets:
        raise ValueError(f"no sheet {sheet!r}; there are {', '.join(sheets)}")
    view = next(book.iter(f"{_MAIN}workbookView"), None)
    active = int(view.get("activeTab", "0")) if view is not None else 0
    key = sheets[sheet] if sheet is not None else [*sheets.values()][min(active, len(sheets) - 1)]
    target = next(r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")) if r.get("Id") == key)
    return target.lstrip("/") if target.startswith("/") else normpath(join("xl", target))


def _number_forms(z: zipfile.ZipFile) -> list[str]:
    """The format code of each cell style that has one of its own."""
    if "xl/styles.xml" not in z.namelist():
        return []
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    codes = {f.get("numFmtId"): f.get("formatCode", "") for f in root.iter(f"{_MAIN}numFmt")}
    return [re.sub(r'[\\"\s]', "", codes.get(x.get("numFmtId"), "")) for x in root.findall(f"{_MAIN}cellXfs/{_MAIN}xf")]


def _shared(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    return ["".join(t.text or "" for t in s.iter(f"{_MAIN}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]


def workbook_cells(data: bytes, sheet: str | None) -> Iterator[tuple[int, int, str]]:
    """(row from 1, column from 0, text) of a workbook's sheet (the active one unless named); blank cells are left out.

    Numbers under a format of 0 and # alone keep its leading zeros.
    """
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared, forms = _shared(z), _number_forms(z)
        with z.open(sheet_part(z, sheet)) as f:
            for _, cell in ElementTree.iterparse(f):
                if cell.tag == f"{_MAIN}row":
                    cell.clear()
                if cell.tag != f"{_MAIN}c":
                    continue
                kind, value = cell.get("t", "n"), cell.findtext(f"{_MAIN}v")
                if kind == "s" and value is not None:
                    text = shared[int(value)]
                elif kind == "inlineStr":
                    text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                elif kind == "b" and value is not None:
                    text = "True" if value == "1" else "False"
                elif kind == "n" and value is not None:
                    number = float(value)
                    text = str(int(number)) if number.is_integer() else value
                    style = int(cell.get("s", "0"))
                    if number.is_integer() and style < len(forms) and re.fullmatch("[0#]*0[0#]*", forms[style]):
                        text = text.zfill(forms[style].count("0"))
                else:
                    text = value or ""
                if text.strip():
                    yield int(re.search(r"\d+", cell.get("r"))[0]), column_number(cell.get("r")), text


def read_workbooks(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """(path, row_index, headers, cells) of the rows of all workbooks at ``path``, each parsed once by one task.

    ``headers`` are those of the row's own workbook and ``cells`` lie under them; further cells make headers null.
    Row numbers count within a workbook. A workbook without data rows gives one row numbered 1 with its headers.
    """

    def rows_of(data: bytes) -> Iterator[tuple[int, list]]:
        row, cells = 1, {}
        for at, place, text in workbook_cells(data, sheet):
            if at != row:
                yield row, cells
                row, cells = at, {}
            cells[place] = text
        yield row, cells

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, data in zip(pdf["path"], pdf["content"], strict=True):
                headers, held = [], []
                listed = lambda cells, least=0: [cells.get(i) for i in range(max([least, *(c + 1 for c in cells)]))]
                for row, cells in rows_of(data):
                    if row == 1:
                        headers = listed(cells)
                    held.append((file, row, headers, listed(cells, len(headers))))
                    if len(held) == 5000:
                        yield pd.DataFrame([r for r in held if r[1] > 1], columns=["path", "row_index", "headers", "cells"])
                        held = held[:1] if held[0][1] == 1 else []
                data_rows = [r for r in held if r[1] > 1]
                yield pd.DataFrame(data_rows or held[:1], columns=["path", "row_index", "headers", "cells"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "path string, row_index int, headers array<string>, cells array<string>")


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """One workbook as a table of text columns and ``row_index``; blank headers are named by their column's number.

    Several workbooks may have other headers and do have the same row numbers: ``read_workbooks`` keeps them apart.
    """
    rows = read_workbooks(spark, path, sheet)
    shape = rows.groupBy("path").agg(F.max("headers").alias("headers"), F.max(F.size("cells")).alias("width")).limit(2).collect()
    if len(shape) > 1:
        raise ValueError("several workbooks: read each by itself, or all with read_workbooks")
    headers, width = (list(shape[0].headers), shape[0].width) if shape else ([], 0)
    names = [h if h else f"column {i + 1}" for i, h in enumerate(headers + [None] * (width - len(headers)))]
    cells = [F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(width)]
    return rows.filter("row_index > 1").select("row_index", *cells).toDF("row_index", *names)


class _Cell(NamedTuple):
    start: int
    end: int
    style: str
    has_formula: bool


def _xml(prefix: str, row: int, place: int, value: Value, style: str = "") -> str:
    p, own = prefix, f' s="{escape(style)}"' if style else ""
    head = f'<{p}c r="{column_letters(place)}{row}"{own}'
    if value is None:
        return f"{head}/>"
    if isinstance(value, bool):
        return f'{head} t="b"><{p}v>{int(value)}</{p}v></{p}c>'
    if isinstance(value, int):
        return f"{head}><{p}v>{value}</{p}v></{p}c>"
    return f'{head} t="inlineStr"><{p}is><{p}t xml:space="preserve">{escape(_UNWRITABLE.sub("", value))}</{p}t></{p}is></{p}c>'


class _Places:
    """Byte places of a sheet's rows, and of the cells of those rows that get values."""

    def __init__(self, xml: bytes, wanted: dict[int, dict[int, Value]]) -> None:
        self.xml, self.wanted = xml, wanted
        self.rows: dict[int, tuple[int, int, int]] = {}  # row: start of its tag, end of its tag, start of its end tag (or its own end)
        self.cells: dict[int, dict[int, _Cell]] = {}
        self.data = (0, 0, 0)
        self.prefix, self.row, self.place, self.dimension = "", 0, -1, None
        self.open: list[int] = []
        self.cell: tuple[int, str] | None = None
        self.formula = False
        parser = expat.ParserCreate()
        parser.StartElementHandler, parser.EndElementHandler = self._start, self._end
        self.parser = parser
        parser.Parse(xml, True)

    def _tag_end(self, at: int) -> int:
        return _TAG.match(self.xml, at).end()

    def _start(self, name: str, given: dict[str, str]) -> None:
        at, plain = self.parser.CurrentByteIndex, name.rpartition(":")[2]
        if plain == "sheetData":
            self.prefix, self.data = name[: -len(plain)], (at, self._tag_end(at), 0)
        elif plain == "dimension":
            self.dimension = (at, self._tag_end(at), given.get("ref", ""))
        elif plain == "row":
            self.row, self.place = int(given.get("r", self.row + 1)), -1
            self.rows[self.row] = (at, self._tag_end(at), 0)
        elif plain == "c" and self.row in self.wanted:
            self.place = column_number(given["r"]) if "r" in given else self.place + 1
            self.cell, self.formula = (at, given.get("s", "")), False
        elif plain == "f":
            self.formula = True

    def _end(self, name: str) -> None:
        at, plain = self.parser.CurrentByteIndex, name.rpartition(":")[2]
        if plain == "c" and self.cell is not None:
            start, style = self.cell
            self.cells.setdefault(self.row, {})[self.place] = _Cell(start, self._tag_end(at), style, self.formula)
            self.cell = None
        elif plain == "row":
            start, tag_end, _ = self.rows[self.row]
            self.rows[self.row] = (start, tag_end, at if at > start else tag_end)
        elif plain == "sheetData":
            start, tag_end, _ = self.data
            self.data = (start, tag_end, at if at > start else tag_end)


def rewritten_sheet(xml: bytes, values: dict[int, dict[int, Value]]) -> tuple[bytes, bool]:
    """(the sheet with ``values`` by row and column, whether a formula went); all other bytes stay as they are.

    Rows and cells that the sheet lacks are put in their places; a set cell keeps its style.
    """
    values = {r: dict(sorted(cells.items())) for r, cells in sorted(values.items()) if cells}
    if not values:
        return xml, False
    at = _Places(xml, values)
    p, edits, formulas = at.prefix, [], False
    order = sorted(at.rows)
    for row, cells in values.items():
        if row in at.rows:
            start, tag_end, close = at.rows[row]
            there, closed = at.cells.get(row, {}), close == tag_end and xml[tag_end - 2 : tag_end] == b"/>"
            added = []
            for place, value in cells.items():
                if place in there:
                    old = there[place]
                    formulas |= old.has_formula
                    edits.append((old.start, old.end, 0, place, _xml(p, row, place, value, old.style)))
                else:
                    after = min((c.start for q, c in there.items() if q > place), default=close)
                    added.append((after, after, 0, place, _xml(p, row, place, value)))
            if closed and added:
                edits.append((tag_end - 2, tag_end, 0, -1, ">" + "".join(a[4] for a in added) + f"</{p}row>"))
            elif not closed:
                edits += added
        else:
            after = next((at.rows[r][0] for r in order if r > row), at.data[2])
            edits.append((after, after, row, -1, f'<{p}row r="{row}">' + "".join(_xml(p, row, c, v) for c, v in cells.items()) + f"</{p}row>"))
    start, tag_end, close = at.data
    if close == tag_end and xml[tag_end - 2 : tag_end] == b"/>":  # an empty sheet
        edits = [(tag_end - 2, tag_end, 0, -1, ">" + "".join(e[4] for e in sorted(edits)) + f"</{p}sheetData>")]
    if at.dimension:
        edits.append((*at.dimension[:2], 0, -1, f'<{p}dimension ref="{_widened(at.dimension[2], values)}"/>'))
    out, done = [], 0
    for begin, end, _, _, text in sorted(edits):
        out += [xml[done:begin], text.encode()]
        done = end
    return b"".join([*out, xml[done:]]), formulas


def _widened(reference: str, values: dict[int, dict[int, Value]]) -> str:
    corners = re.findall(r"([A-Z]+)(\d+)", reference) or [("A", "1")]
    columns = [column_number(c) for c, _ in corners] + [c for cells in values.values() for c in cells]
    rows = [int(r) for _, r in corners] + list(values)
    return f"{column_letters(min(columns))}{min(rows)}:{column_letters(max(columns))}{max(rows)}"


def rewritten(data: bytes, sheet: str | None, values: dict[int, dict[int, Value]]) -> bytes:
    """The workbook with ``values`` (row from 1 to column from 0 to value) set in a sheet; None empties a cell.

    Where a formula is written over, the list of the order of calculation goes too: it would name a cell that has none.
    """
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(data)) as z, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as to:
        part = sheet_part(z, sheet)
        changed, formulas = rewritten_sheet(z.read(part), values)
        for item in z.infolist():
            content = changed if item.filename == part else z.read(item)
            if formulas and item.filename == "xl/calcChain.xml":
                continue
            if formulas and item.filename in ("xl/_rels/workbook.xml.rels", "[Content_Types].xml"):
                content = re.sub(rb"<(?:Relationship|Override)\b[^>]*calcChain[^>]*/>", b"", content)
            to.writestr(item, content)
    return out.getvalue()


def write_workbook(source: str, target: str, cells: DataFrame, sheet: str | None = None) -> int:
    """Write the workbook at ``source`` to ``target`` with ``cells`` (row_index, values map<int, string>) set; returns its bytes.

    Values of digits alone under 16 of them are written as numbers if their cell says so in ``numeric`` (array<int> of
    columns), all others as text. One task does it, as the format demands. Where ``target`` is ``source``, a copy is
    made beside it first (name.backup.<time>.xlsx); the new file is moved into place whole.
    """
    spark, stamp = cells.sparkSession, f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}"
    source, target = versions.qualified(spark, source), versions.qualified(spark, target)

    def save(key: tuple, files: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        values: dict[int, dict[int, Value]] = {}
        for row, given, numeric in zip(rows["row_index"], rows["values"], rows["numeric"], strict=True):
            given, numbers = dict(given), set(numeric)
            values[int(row)] = {int(c): int(v) if v is not None and int(c) in numbers and re.fullmatch(r"\d{1,15}", v) else v for c, v in given.items()}
        data = rewritten(files["content"][0], sheet, values)
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            if z.testzip() is not None:
                raise OSError("the workbook that was made can't be read back")
        store, place = fs.FileSystem.from_uri(target)
        if target == source:
            stem, _, ending = place.rpartition(".")
            store.copy_file(place, f"{stem}.backup.{stamp}.{ending}")
        with store.open_output_stream(f"{place}.{stamp}.part") as f:
            f.write(data)
        store.move(f"{place}.{stamp}.part", place)
        return pd.DataFrame({"size": [len(data)]})

    files = spark.read.format("binaryFile").load(source).select(F.lit(0).alias("k"), "content")
    rows = cells.select(F.lit(0).alias("k"), "row_index", "values", "numeric")
    return files.groupBy("k").cogroup(rows.groupBy("k")).applyInPandas(save, "size long").first()["size"]
