"""The table template as an .xlsx file: reading its axes and filling a copy, on the file system that the path names."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from framegrid.sources.sinks import filesystem, write_file

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_LINK = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
#: The sheet that holds the table.
SHEET = "Sheet1"


def _opened(path: str) -> zipfile.ZipFile:
    """A sheet is one document's table, so it is held in memory."""
    at, inside = filesystem(path)
    with at.open_input_stream(inside) as f:
        return zipfile.ZipFile(io.BytesIO(f.read()))


def _column(i: int) -> str:
    return (chr(64 + (i - 1) // 26) if i > 26 else "") + chr(65 + (i - 1) % 26)


def _sheet_path(z: zipfile.ZipFile, name: str) -> str:
    """The part that holds the named sheet."""
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    links = ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    targets = {x.attrib["Id"]: x.attrib["Target"] for x in links}
    sheets = book.findall("m:sheets/m:sheet", _NS)
    chosen = next((x for x in sheets if x.attrib["name"] == name), None)
    if chosen is None:
        raise KeyError(f"no sheet {name!r}, only {', '.join(repr(x.attrib['name']) for x in sheets)}")
    target = targets[chosen.attrib[f"{{{_LINK}}}id"]]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _place(reference: str) -> tuple[int, int]:
    letters, row = re.fullmatch(r"([A-Z]+)(\d+)", reference).groups()
    col = 0
    for x in letters:
        col = col * 26 + ord(x) - 64
    return int(row), col


def _cells(path: str, name: str = SHEET) -> dict[tuple[int, int], str]:
    with _opened(path) as z:
        strings = []
        if "xl/sharedStrings.xml" in z.namelist():
            strings = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        root = ElementTree.fromstring(z.read(_sheet_path(z, name)))
    out = {}
    for c in root.iter(f"{{{_NS['m']}}}c"):
        v, inline = c.find("m:v", _NS), c.find("m:is/m:t", _NS)
        text = inline.text if inline is not None else v.text if v is not None else None
        if text is not None:
            out[_place(c.attrib["r"])] = strings[int(text)] if c.attrib.get("t") == "s" else text
    return out


def axes(path: str) -> tuple[int, int]:
    """How many columns have a header and how many rows a label; blanks do not count."""
    cells = _cells(path)
    return sum(1 for r, c in cells if r == 1 and c > 1), sum(1 for r, c in cells if r > 1 and c == 1)


def fill(template: str | None, path: str, cells: Iterable[tuple[int, int, str]], headers: tuple[list[str], list[str]] = ((), ())) -> None:
    """Write (col_idx, row_idx, text) cells as text into a copy of the template, all else of which stays, or into a new sheet under the given headers."""
    wanted = {(2 + row, 2 + col): text for col, row, text in cells}
    if template:
        _fill_copy(template, path, wanted)
    else:
        held = {(1, 2 + i): h for i, h in enumerate(headers[0])} | {(2 + i, 1): h for i, h in enumerate(headers[1])}
        _new(path, held | wanted)


def _fill_copy(template: str, path: str, wanted: dict[tuple[int, int], str]) -> None:
    main = _NS["m"]
    ElementTree.register_namespace("", main)
    ElementTree.register_namespace("r", _LINK)
    held = io.BytesIO()
    with _opened(template) as z, zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as out:
        at = _sheet_path(z, SHEET)
        style, styles = _text_style(z)
        root = ElementTree.fromstring(z.read(at))
        data = root.find("m:sheetData", _NS)
        rows = {int(r.attrib["r"]): r for r in data}
        for (r, c), text in sorted(wanted.items()):
            if r not in rows:
                rows[r] = ElementTree.SubElement(data, f"{{{main}}}row", {"r": str(r)})
            there = {_place(x.attrib["r"])[1]: x for x in rows[r]}
            cell = there.get(c)
            if cell is None:
                cell = ElementTree.SubElement(rows[r], f"{{{main}}}c", {"r": f"{_column(c)}{r}"})
            for x in list(cell):
                cell.remove(x)
            cell.attrib |= {"t": "inlineStr"} | ({"s": str(style)} if style is not None else {})
            t = ElementTree.SubElement(ElementTree.SubElement(cell, f"{{{main}}}is"), f"{{{main}}}t", {"{http://www.w3.org/XML/1998/namespace}space": "preserve"})
            t.text = text
            rows[r][:] = sorted(rows[r], key=lambda x: _place(x.attrib["r"])[1])
        data[:] = sorted(data, key=lambda x: int(x.attrib["r"]))
        for name in z.namelist():
            if name == at:
                out.writestr(name, ElementTree.tostring(root, "utf-8", xml_declaration=True))
            elif name == "xl/styles.xml" and styles is not None:
                out.writestr(name, styles)
            else:
                out.writestr(name, z.read(name))
    write_file(path, held.getvalue())


def _text_style(z: zipfile.ZipFile) -> tuple[int | None, bytes | None]:
    """The number of a style for text, added to the template's styles."""
    if "xl/styles.xml" not in z.namelist():
        return None, None
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    styles = root.find("m:cellXfs", _NS)
    if styles is None:
        return None, None
    ElementTree.SubElement(styles, f"{{{_NS['m']}}}xf", {"numFmtId": "49", "fontId": "0", "fillId": "0", "borderId": "0", "xfId": "0", "applyNumberFormat": "1"})
    styles.attrib["count"] = str(len(styles))
    return len(styles) - 1, ElementTree.tostring(root, "utf-8", xml_declaration=True)


def _new(path: str, held: dict[tuple[int, int], str]) -> None:
    rows: dict[int, list[str]] = {}
    for (r, c), text in sorted(held.items()):
        rows.setdefault(r, []).append(f'<c r="{_column(c)}{r}" s="1" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>')
    body = "".join(f'<row r="{r}">{"".join(x)}</row>' for r, x in rows.items())
    main = _NS["m"]
    rel = _LINK
    package = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{SHEET}" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Type="{rel}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf numFmtId="49" applyNumberFormat="1"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>{text}')
    write_file(path, out.getvalue())
