"""What people-list files are written in, and workbook sheets to rows, one workbook at a time inside tasks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd

# Encodings tried in this order, strictly.
ENCODINGS = ("utf-8-sig", "cp1252", "latin-1")
CHUNK_ROWS = 20_000
# Separators looked for in a header.
SEPARATORS = (",", ";", "\t")

# Cell texts read as null.
NULL_TEXTS = {
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
}

_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _cell_text(cell: ElementTree.Element, shared: list[str]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join(node.text or "" for node in cell.iter(f"{_SHEET}t"))
    value = cell.find(f"{_SHEET}v")
    if value is None or value.text is None:
        return None
    return shared[int(value.text)] if kind == "s" else value.text


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def workbook_chunks(content: bytes, sheet_name: str | None, rows: int | None = None) -> Iterator[pd.DataFrame]:
    """Text rows of one sheet of an ``.xlsx`` workbook (the first sheet by default)."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        sheets = {
            node.get("name"): node.get(f"{_RELATION}id")
            for node in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_SHEET}sheet")
        }
        name = next(iter(sheets)) if sheet_name is None else sheet_name
        if name not in sheets:
            raise ValueError(f"Worksheet named {name!r} not found")
        links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        target = next(node.get("Target") for node in links if node.get("Id") == sheets[name])
        part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")):
                shared.append("".join(node.text or "" for node in item.iter(f"{_SHEET}t")))
        header: list[str] = []
        kept: list[list[str | None]] = []
        done = 0
        with book.open(part) as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{_SHEET}row":
                    continue
                cells: dict[int, str | None] = {}
                for place, cell in enumerate(row.findall(f"{_SHEET}c")):
                    number = _column_number(cell.get("r")) if cell.get("r") else place
                    cells[number] = _cell_text(cell, shared)
                row.clear()
                if not header:
                    header = [cells.get(i) or f"Unnamed: {i}" for i in range(max(cells, default=-1) + 1)]
                    continue
                if rows is not None and done >= rows:
                    break
                done += 1
                texts = [cells.get(i) for i in range(len(header))]
                kept.append([None if t is None or t in NULL_TEXTS else t for t in texts])
                if len(kept) == CHUNK_ROWS:
                    yield pd.DataFrame(kept, columns=header, dtype=object)
                    kept = []
        yield pd.DataFrame(kept, columns=header, dtype=object)
