"""Spreadsheets at the edge, with the standard library alone: a sheet is a zip of XML. For hand-written frameworks and small deliverables, not for corpora."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
LONGEST_CELL = 32767


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def _letters(i: int) -> str:
    out = ""
    while i >= 0:
        out, i = chr(65 + i % 26) + out, i // 26 - 1
    return out


def _texts(node) -> str:
    """Text of a plain or a rich string, without phonetic hints."""
    return "".join(t.text or "" for child in node if not child.tag.endswith("}rPh") for t in child.iter(f"{{{_NS['m']}}}t"))


def read_sheet(content: bytes) -> tuple[list[str], list[list[str | None]]]:
    """Header and rows of the first sheet, all cells as text; cells such as NA stay text, blank ones are None."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = [_texts(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)] if "xl/sharedStrings.xml" in names else []
        first = ET.fromstring(z.read("xl/workbook.xml")).find("m:sheets/m:sheet", _NS).get(_REL)
        target = next(r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")) if r.get("Id") == first)
        sheet = ET.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    rows = []
    for row in sheet.iterfind("m:sheetData/m:row", _NS):
        cells: dict[int, str | None] = {}
        for k, c in enumerate(row.findall("m:c", _NS)):
            kind, value = c.get("t"), c.find("m:v", _NS)
            text = _texts(c.find("m:is", _NS)) if kind == "inlineStr" and c.find("m:is", _NS) is not None else None if value is None else shared[int(value.text)] if kind == "s" else value.text
            cells[_column(c.get("r")) if c.get("r") else k] = text
        at = int(row.get("r") or len(rows) + 1)
        rows += [[] for _ in range(at - 1 - len(rows))]  # rows left out are blank
        rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
    if not rows:
        return [], []
    head, width = [x or "" for x in rows[0]], len(rows[0])
    body = [(r + [None] * width)[:width] for r in rows[1:]]
    return head, [r for r in body if any(x not in (None, "") for x in r)]


def write_sheet(columns: list[str], rows: list[tuple]) -> bytes:
    """One sheet with a header; numbers stay numbers, everything else is text. Written with its header even if there are no rows."""

    def cell(i: int, j: int, v) -> str:
        if v is None:
            return ""
        ref = f"{_letters(j)}{i}"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f'<c r="{ref}"><v>{v!r}</v></c>'
        text = re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]", "", str(v))[:LONGEST_CELL]
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'

    lines = [f'<row r="{i}">{"".join(cell(i, j, v) for j, v in enumerate(r))}</row>' for i, r in enumerate([tuple(columns), *rows], 1)]
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    kind, doc = "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "application/vnd.openxmlformats-officedocument.spreadsheetml"
    pack = "http://schemas.openxmlformats.org/package/2006"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{doc}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{doc}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{pack}/relationships"><Relationship Id="rId1" Type="{kind}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{_NS["m"]}" xmlns:r="{kind}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{pack}/relationships"><Relationship Id="rId1" Type="{kind}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{_NS["m"]}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in parts.items():
            z.writestr(name, head + body)
    return out.getvalue()
