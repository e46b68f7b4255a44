"""Workbooks (OOXML) as ordered sheet rows, one task per group of files."""

from __future__ import annotations

import io
import posixpath
import re
import sys
import zipfile
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuota.specs import SHEET_ROWS_DDL

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package installed

_BATCH_ROWS = 4096
# Built-in number formats that show a date or a time.
_DATE_FORMATS = frozenset((14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47))
# Parts of a custom number format that say nothing about its kind: quoted text, colours, escapes, padding.
_FORMAT_NOISE = re.compile(r'"[^"]*"|\[(?!h+\]|m+\]|s+\])[^\]]*\]|\\.|_.', re.I)


def read_workbooks(spark: SparkSession, path: str | list[str], *, on_bad_file: str = "raise") -> DataFrame:
    """(file, sheet, sheet_pos, row_no, cells, types): values only, rows numbered from 0 in sheet order.

    A sheet without rows gives one row without cells. With on_bad_file='reject' a file that cannot be read does not end
    the job; store the rows and part them with `rejected_workbooks` and `whole_workbooks`.
    """
    if on_bad_file not in ("raise", "reject"):
        raise ValueError(f"on_bad_file must be 'raise' or 'reject', not {on_bad_file!r}")
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(lambda batches: _sheet_rows(batches, on_bad_file == "reject"), SHEET_ROWS_DDL)


def rejected_workbooks(rows: DataFrame) -> DataFrame:
    """(file, problem) of every file that could not be read to its end."""
    return rows.filter(F.col("sheet").isNull()).select("file", F.get("cells", F.lit(0)).alias("problem"))


def whole_workbooks(rows: DataFrame) -> DataFrame:
    """The rows of files that were read to their end. Pass stored rows: they are read twice."""
    return rows.join(rejected_workbooks(rows).select("file"), "file", "left_anti")


def workbook_sheets(rows: DataFrame) -> DataFrame:
    """(file, sheet, sheet_pos) of every sheet."""
    return rows.filter(F.col("sheet").isNotNull()).groupBy("file", "sheet").agg(F.min("sheet_pos").alias("sheet_pos"))


def _sheet_rows(batches, reject):
    columns = ["file", "sheet", "sheet_pos", "row_no", "cells", "types"]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            buffer = []
            try:
                for row in _workbook_rows(content):
                    buffer.append((path, *row))
                    if len(buffer) == _BATCH_ROWS:
                        yield pd.DataFrame(buffer, columns=columns)
                        buffer = []
            except Exception as problem:  # whatever a damaged archive or its XML leads to
                if not reject:
                    raise
                # One row without a sheet marks the file; rows handed on before are told apart by it.
                buffer = [(path, None, 0, 0, [f"{type(problem).__name__}: {problem}"], ["s"])]
            if buffer:
                yield pd.DataFrame(buffer, columns=columns)


def _local(tag):
    return tag.rsplit("}", 1)[-1]


def _xml(archive, name):
    return ElementTree.fromstring(archive.read(name)) if name in archive.namelist() else None


def _children(node, name):
    return [child for child in node.iter() if _local(child.tag) == name] if node is not None else []


def _joined_text(node):
    # Phonetic hints are not part of the value.
    hidden = {id(t) for hint in _children(node, "rPh") for t in _children(hint, "t")}
    return "".join(t.text or "" for t in _children(node, "t") if id(t) not in hidden)


def _date_styles(styles):
    custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in _children(styles, "numFmt")}
    found = set()
    for block in _children(styles, "cellXfs"):
        for index, style in enumerate(block):
            number_format = int(style.get("numFmtId", 0))
            code = _FORMAT_NOISE.sub("", custom.get(number_format, "").split(";")[0])
            if number_format in _DATE_FORMATS or re.search("[dmhys]", code, re.I):
                found.add(index)
    return found


def _workbook_rows(content):
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        book = _xml(archive, "xl/workbook.xml")
        targets = {r.get("Id"): r.get("Target") for r in _xml(archive, "xl/_rels/workbook.xml.rels")}
        strings = [_joined_text(item) for item in _children(_xml(archive, "xl/sharedStrings.xml"), "si")]
        dates = _date_styles(_xml(archive, "xl/styles.xml"))
        since_1904 = any(p.get("date1904") in ("1", "true") for p in _children(book, "workbookPr"))
        epoch = datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 30)
        for position, sheet in enumerate(_children(book, "sheet")):
            relation = next(v for k, v in sheet.attrib.items() if _local(k) == "id")
            target = targets[relation]
            name = target.lstrip("/") if target.startswith("/") else posixpath.normpath("xl/" + target)
            empty = True
            with archive.open(name) as stream:
                for row_no, cells, types in _rows(stream, strings, dates, epoch):
                    empty = False
                    yield sheet.get("name"), position, row_no, cells, types
            if empty:
                yield sheet.get("name"), position, 0, [], []


def _rows(stream, strings, dates, epoch):
    expected, parent = 0, None
    for event, node in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start":
            parent = node if _local(node.tag) == "sheetData" else parent
            continue
        if _local(node.tag) != "row":
            continue
        row_no = int(node.get("r", expected + 1)) - 1
        while expected < row_no:  # rows the file leaves out
            yield expected, [], []
            expected += 1
        cells, types = [], []
        for cell in node:
            column = _column(cell.get("r"), len(cells))
            cells.extend([None] * (column - len(cells)))
            types.extend([None] * (column - len(types)))
            value, kind = _value(cell, strings, dates, epoch)
            cells.append(value)
            types.append(kind)
        yield row_no, cells, types
        expected = row_no + 1
        node.clear()
        if parent is not None:
            parent.clear()  # else a full sheet leaves a million emptied rows behind


def _column(reference, default):
    if not reference:
        return default
    number = 0
    for char in reference:
        if not char.isalpha():
            break
        number = number * 26 + ord(char.upper()) - 64
    return number - 1


def _value(cell, strings, dates, epoch):
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _joined_text(cell), "s"
    raw = next((child.text for child in cell if _local(child.tag) == "v"), None)
    if raw is None:
        return None, None
    if kind == "s":
        return strings[int(raw)], "s"
    if kind == "b":
        return ("1" if raw == "1" else "0"), "b"
    if kind == "d":
        return raw.replace("T", " "), "d"
    if kind == "n":
        if int(cell.get("s", 0)) in dates:
            return str(epoch + timedelta(days=float(raw))), "d"
        # Spreadsheets store 0.1 as 0.10000000000000001.
        return (str(float(raw)) if any(c in raw for c in ".eE") else raw), "n"
    return raw, "s"
