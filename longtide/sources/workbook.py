"""Rows of the sheets of an XLSX workbook, read with the standard library."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(content: bytes, sheets: list[int] | None = None) -> Iterator[tuple[int, int, list[str | None]]]:
    """(sheet number, row number, cells as text) of the listed sheets, or of all; gaps between cells are None."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_NS}si")]
        numbers = sorted(int(m[1]) for n in names if (m := re.fullmatch(r"xl/worksheets/sheet(\d+)\.xml", n)))
        for at in numbers if sheets is None else [n for n in numbers if n in sheets]:
            for row, cells in _rows(z, f"xl/worksheets/sheet{at}.xml", shared):
                yield at, row, cells


def _rows(z: zipfile.ZipFile, sheet: str, shared: list[str]) -> Iterator[tuple[int, list[str | None]]]:
    for _, el in ElementTree.iterparse(z.open(sheet)):
        if el.tag != f"{_NS}row":
            continue
        cells: list[str | None] = []
        for c in el.iter(f"{_NS}c"):
            at = _column(c.get("r")) if c.get("r") else len(cells)
            cells += [None] * (at - len(cells))
            v, inline = c.find(f"{_NS}v"), c.find(f"{_NS}is")
            text = "".join(t.text or "" for t in inline.iter(f"{_NS}t")) if inline is not None else (v.text if v is not None else None)
            cells.append(shared[int(text)] if c.get("t") == "s" and text is not None else text)
        yield int(el.get("r", 0)), cells
        el.clear()
