"""Excel workbooks: first sheet, first row as header."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrasift.sources.cells import BATCH_ROWS, FLAG, MOMENT, NUMBER, TEXT, cell, read_files, schema_of, type_cells
from terrasift.sources.typing import NA_TOKENS

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_EPOCH = datetime(1899, 12, 30)

# Built-in number formats that show a date or time.
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def _column_index(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_NS}t"))


class _Book:
    """Streaming view of the first sheet of one workbook."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        names = set(self.zip.namelist())
        self.shared = []
        if "xl/sharedStrings.xml" in names:
            root = ET.fromstring(self.zip.read("xl/sharedStrings.xml"))
            self.shared = [_text(si) for si in root.iter(f"{_NS}si")]
        self.dates = self._date_styles() if "xl/styles.xml" in names else set()
        self.sheet = self._first_sheet()

    def _first_sheet(self) -> str:
        book = ET.fromstring(self.zip.read("xl/workbook.xml"))
        rid = next(book.iter(f"{_NS}sheet")).get(f"{_REL}id")
        rels = ET.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))
        target = next(r.get("Target") for r in rels if r.get("Id") == rid)
        return target.lstrip("/") if target.startswith("/") else f"xl/{target}"

    def _date_styles(self) -> set[int]:
        root = ET.fromstring(self.zip.read("xl/styles.xml"))
        custom = {
            int(f.get("numFmtId"))
            for f in root.iter(f"{_NS}numFmt")
            if re.search(r"[ymdh]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "").lower()))
        }
        formats = root.find(f"{_NS}cellXfs")
        ids = [int(x.get("numFmtId", 0)) for x in formats] if formats is not None else []
        return {i for i, f in enumerate(ids) if f in _DATE_FORMATS or f in custom}

    def _value(self, c) -> str | None:
        kind, v = c.get("t", "n"), c.find(f"{_NS}v")
        if kind == "inlineStr":
            return cell(TEXT, _text(c))
        if v is None or v.text is None:
            return None
        if kind == "s":
            return cell(TEXT, self.shared[int(v.text)])
        if kind == "b":
            return cell(FLAG, v.text)
        if kind == "e":
            return None
        if kind == "str":
            return cell(TEXT, v.text)
        if kind == "d":
            return cell(MOMENT, v.text)
        if int(c.get("s", 0)) in self.dates:
            return cell(MOMENT, str(_EPOCH + timedelta(seconds=round(float(v.text) * 86400))))
        return cell(NUMBER, v.text)

    def rows(self) -> Iterator[list[str | None]]:
        with self.zip.open(self.sheet) as f:
            for _, row in ET.iterparse(f):
                if row.tag != f"{_NS}row":
                    continue
                out: list[str | None] = []
                for i, c in enumerate(row.iter(f"{_NS}c")):
                    at = _column_index(c.get("r")) if c.get("r") else i
                    out.extend([None] * (at + 1 - len(out)))
                    out[at] = self._value(c)
                yield out
                row.clear()


def _is_missing(value: str | None) -> bool:
    return value is None or (value[0] == TEXT and value[1:] in NA_TOKENS)


def _header(rows: Iterator[list[str | None]]) -> list[str]:
    names, seen = [], {}
    for i, v in enumerate(next(rows, [])):
        name = v[1:] if v else f"Unnamed: {i}"
        seen[name] = seen.get(name, -1) + 1
        names.append(f"{name}.{seen[name]}" if seen[name] else name)
    return names


def _header_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        heads = [_header(_Book(c).rows()) for c in pdf["content"]]
        yield pd.DataFrame({"path": pdf["path"].tolist(), "names": heads})


def _record_batches(names: list[str]):
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                rows = _Book(content).rows()
                own = _header(rows)
                # Columns are matched by name, so workbooks may order them differently.
                places = [own.index(n) if n in own else None for n in names]
                buffer = []
                for row in rows:
                    cells = [None if p is None or p >= len(row) or _is_missing(row[p]) else row[p] for p in places]
                    if any(x is not None for x in row):
                        buffer.append(cells)
                    if len(buffer) >= BATCH_ROWS:
                        yield pd.DataFrame({"path": path, "cells": buffer})
                        buffer = []
                if buffer:
                    yield pd.DataFrame({"path": path, "cells": buffer})

    return decode


def decode_workbooks(files: DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    """Rows of all workbooks in a (path, content) frame, columns typed over all of them.

    With a schema the files are read once; without one, the headers and the
    kinds of the cells are gathered first.
    """
    schema = schema_of(schema)
    if schema is not None:
        names = schema.names
    else:
        heads = files.mapInPandas(_header_batches, "path string, names array<string>")
        # The union of the headers is bounded by the sheet width, not by the rows.
        spread = heads.select("path", F.posexplode("names").alias("at", "name"))
        found = spread.groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name").collect()
        names = [r["name"] for r in found]
    records = files.mapInPandas(_record_batches(names), "path string, cells array<string>")
    return type_cells(records, names, schema=schema)


def read_workbooks(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One workbook, or every workbook below a folder."""
    return decode_workbooks(read_files(spark, path, (".xlsx",)), schema)


def workbook_bytes(names: list[str], rows: list[tuple]) -> bytes:
    """A one-sheet workbook, as test input and as a hand-over format."""

    def one(v) -> str:
        if v is None or v != v:
            return "<c/>"
        if isinstance(v, bool):
            return f'<c t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f"<c><v>{v!r}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    lines = ["<row>" + "".join(one(v) for v in row) + "</row>" for row in [tuple(names), *rows]]
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pkg = "http://schemas.openxmlformats.org/package/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{pkg}"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        z.writestr(
            "xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>'
        )
    return out.getvalue()
