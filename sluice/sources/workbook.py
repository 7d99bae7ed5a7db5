"""Cells of workbooks (.xlsx) as rows, and code lists read from their sheets.

A workbook is a zip of XML: the names of its sheets, texts that cells share, and a file for each sheet. Workbooks are read as
whole binary rows, each by one task, which streams through a sheet and sends its rows on; their number may be any. A file
that is no workbook, or lacks a part of one, is an error that names it.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.clean import strip
from sluice.operators import ranges

SCHEMA = "path string, sheet string, row int, cells array<string>"
#: The names that the format gives its parts.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _at(reference: str) -> tuple[int, int]:
    """Row from 1 and column from 0 of a reference such as AB12."""
    letters, digits = re.fullmatch(r"([A-Z]+)(\d+)", reference).groups()
    column = 0
    for letter in letters:
        column = 26 * column + ord(letter) - 64
    return int(digits), column - 1


def _text(node) -> str:
    """The text of an element without its phonetic hints."""
    return "".join(t.text or "" for child in node if child.tag != _MAIN + "rPh" for t in child.iter(_MAIN + "t"))


def sheets(content: bytes) -> Iterator[tuple[str, int, dict[int, str]]]:
    """(sheet, row, column -> text) of every row with a value; a merged region has its first cell's text throughout."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        texts = [_text(node) if len(node) else "" for node in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(_MAIN + "sheet"):
            target = targets[sheet.get(_REL)]
            root = ElementTree.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
            rows: dict[int, dict[int, str]] = {}
            for cell in root.iter(_MAIN + "c"):
                value, kind = cell.find(_MAIN + "v"), cell.get("t")
                if kind == "inlineStr":
                    text = _text(cell.find(_MAIN + "is"))
                elif value is None or value.text is None or kind == "e":
                    continue
                else:
                    text = texts[int(value.text)] if kind == "s" else value.text
                row, column = _at(cell.get("r"))
                rows.setdefault(row, {})[column] = text
            for merged in root.iter(_MAIN + "mergeCell"):
                (top, left), (bottom, right) = map(_at, merged.get("ref").split(":"))
                if (first := rows.get(top, {}).get(left)) is not None:
                    for row in range(top, bottom + 1):
                        for column in range(left, right + 1):
                            rows.setdefault(row, {})[column] = first
            yield from ((sheet.get("name"), row, rows[row]) for row in sorted(rows))


def read_workbook(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, sheet, row, cells): every row with a value of every sheet; numbers as they are stored, missing cells null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    found = list(sheets(content))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, AttributeError, ValueError, IndexError) as e:
                    raise ValueError(f"{name} is no workbook: {type(e).__name__} {e}") from e
                for at in range(0, len(found), 1000):
                    part = found[at : at + 1000]
                    cells = [[own.get(i) for i in range(max(own) + 1)] for _, _, own in part]
                    columns = [pa.array([name] * len(part)), pa.array([s for s, _, _ in part]), pa.array([r for _, r, _ in part], pa.int32()), pa.array(cells, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "sheet", "row", "cells"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # a workbook is a row
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, SCHEMA)


def code_list(book: DataFrame, sheet: str, columns: Sequence[str], *, groups: Sequence[str] = (), header: int = 1) -> DataFrame:
    """(path, row, *columns) of a sheet below its header, trimmed, empty cells null; ``groups`` are filled forward.

    A missing sheet is an error. Rows without a value in any other column than ``groups`` only open a group and go.
    """
    rows = book.where(F.col("sheet") == sheet)
    if missing := [r["path"] for r in book.select("path").distinct().join(rows.select("path").distinct(), "path", "left_anti").limit(5).collect()]:
        raise ValueError(f"no sheet {sheet!r} in {missing}")
    cell = lambda i: F.nullif(strip(F.get("cells", F.lit(i))), F.lit(""))
    out = rows.where(F.col("row") > header).select("path", "row", *[cell(i).alias(c) for i, c in enumerate(columns)])
    if groups:
        out = ranges.forward_fill(out, list(groups), ["path"], ["row"])
    rest = [F.col(c).isNotNull() for c in columns if c not in groups]
    held = F.lit(False)
    for c in rest:
        held = held | c
    return out.where(held)


def code(c: Column, digits: int) -> Column:
    """A whole number, stored as text or as a number, as a code of ``digits`` places; null otherwise."""
    number = c.try_cast("double")
    text = number.cast("long").cast("string")
    return F.when(number % 1 == 0, F.when(F.length(text) >= digits, text).otherwise(F.lpad(text, digits, "0")))  # lpad alone cuts
