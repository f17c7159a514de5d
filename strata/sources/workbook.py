"""Workbooks (.xlsx) as DataFrames.

A workbook is a zip of XML parts and cannot be split, so each one is read by one task; a sheet ends at 1,048,576 rows,
which bounds that task. Many workbooks are many tasks. Two passes: the first finds every header and which columns hold
anything, the second yields the rows. Rows are streamed out of the XML, never held whole.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections import Counter
from xml.etree.ElementTree import iterparse

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import fixed
from strata.functions.text import col
from strata.session import ship_package

PATH_COLUMN = "__path"
_BATCH = 4096
_NULLS = frozenset(fixed.WORKBOOK_NULLS)


# ---- options -----------------------------------------------------------------------------------------------


def sheet_choice(options: dict) -> int | str:
    """``sheet_name`` (a name, or a number as int or text) before ``sheet_index`` before the first sheet."""
    name = options.get("sheet_name")
    if name is None or not str(name).strip():
        return int(options.get("sheet_index", 0))
    return int(name) if str(name).strip().lstrip("-").isdigit() else str(name)


def row_window(options: dict) -> tuple[int, int, int]:
    """(header row, first data row, last data row), 1-based and inclusive."""
    if "header_row" not in options:
        raise ValueError("a workbook source needs 'header_row'")
    header = int(options["header_row"])
    start = int(options.get("data_start_row") or header + 1)
    return header, start, int(options.get("data_end_row") or fixed.WORKBOOK_LAST_ROW)


def column_index(letters: str) -> int:
    index = 0
    for letter in letters.strip().upper():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def column_letters(count: int) -> str:
    """Letters of the ``count``-th column: 1 -> A, 27 -> AA."""
    letters = ""
    while count:
        count, rest = divmod(count - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters


def wanted_columns(usecols: str | None) -> set[int] | None:
    """'A:C,F' -> {0, 1, 2, 5}; None means every column."""
    if not usecols:
        return None
    wanted = set()
    for piece in str(usecols).split(","):
        first, _, last = piece.partition(":")
        wanted.update(range(column_index(first), column_index(last or first) + 1))
    return wanted


# ---- cells of one sheet, inside a task ---------------------------------------------------------------------


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _texts(element) -> str:
    return "".join(t.text or "" for t in element.iter() if _local(t.tag) == "t")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    strings = []
    for _, element in iterparse(book.open("xl/sharedStrings.xml")):
        if _local(element.tag) == "si":
            strings.append(_texts(element))
            element.clear()
    return strings


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell styles that show a number as a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    codes, styles, inside = {}, set(), False
    for event, element in iterparse(book.open("xl/styles.xml"), events=("start", "end")):
        tag = _local(element.tag)
        if tag == "cellXfs":
            inside, position = event == "start", 0
        elif event == "end" and tag == "numFmt":
            codes[int(element.get("numFmtId"))] = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", element.get("formatCode", ""))
        elif event == "end" and tag == "xf" and inside:
            number = int(element.get("numFmtId", 0))
            if 14 <= number <= 22 or 45 <= number <= 47 or re.search("[ymdhs]", codes.get(number, "").lower()):
                styles.add(position)
            position += 1
    return styles


def _sheet_part(book: zipfile.ZipFile, choice: int | str) -> tuple[str, bool]:
    sheets, from_1904 = [], False
    for _, element in iterparse(book.open("xl/workbook.xml")):
        if _local(element.tag) == "sheet":
            link = next(v for k, v in element.attrib.items() if _local(k) == "id" and k != "sheetId")
            sheets.append((element.get("name"), link))
        elif _local(element.tag) == "workbookPr":
            from_1904 = element.get("date1904") in ("1", "true")
    links = {
        e.get("Id"): e.get("Target")
        for _, e in iterparse(book.open("xl/_rels/workbook.xml.rels"))
        if _local(e.tag) == "Relationship"
    }
    names = [name for name, _ in sheets]
    position = choice if isinstance(choice, int) else names.index(choice) if choice in names else None
    if position is None or not -len(sheets) <= position < len(sheets):
        raise ValueError(f"sheet {choice!r} not found; the workbook has {names}")
    target = links[sheets[position][1]]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}", from_1904


def _number_text(raw: str, is_date: bool, from_1904: bool) -> str:
    number = float(raw)
    if is_date:
        epoch = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 30)
        moment = epoch + dt.timedelta(seconds=round(number * 86400))
        return str(moment)
    return str(int(number)) if number.is_integer() else str(number)


def sheet_rows(content: bytes, choice: int | str, wanted: set[int] | None):
    """Yields (row number, {column index: text}) of the rows present in the sheet."""
    book = zipfile.ZipFile(io.BytesIO(content))
    part, from_1904 = _sheet_part(book, choice)
    shared, dates = _shared_strings(book), _date_styles(book)
    number, cells = 0, {}
    for event, element in iterparse(book.open(part), events=("start", "end")):
        tag = _local(element.tag)
        if tag == "row" and event == "start":
            number, cells = int(element.get("r") or number + 1), {}
        elif tag == "row":
            yield number, cells
            element.clear()
        elif tag == "c" and event == "end":
            reference = re.match("[A-Z]+", element.get("r") or "")
            index = column_index(reference.group()) if reference else len(cells)
            if wanted is not None and index not in wanted:
                continue
            kind = element.get("t", "n")
            value = next((v.text for v in element if _local(v.tag) == "v"), None)
            if kind == "inlineStr":
                text = _texts(element)
            elif value is None or kind == "e":
                continue
            elif kind == "s":
                text = shared[int(value)]
            elif kind == "b":
                text = str(value == "1")
            elif kind in ("str", "d"):
                text = value
            else:
                text = _number_text(value, int(element.get("s", 0)) in dates, from_1904)
            if text not in _NULLS:
                cells[index] = text


def _header_names(cells: dict[int, str], wanted: set[int] | None, width: int) -> dict[int, str]:
    """Column index -> name. Blank headers become col_N; a name that is taken gets .1, .2 and so on."""
    repeats, taken, names = Counter(), set(), {}
    for index in sorted(wanted if wanted is not None else range(width)):
        if index >= width:
            break
        name = given = cells.get(index, f"col_{index}")
        while name in taken:
            repeats[given] += 1
            name = f"{given}.{repeats[given]}"
        taken.add(name)
        names[index] = name
    return names


# ---- DataFrames --------------------------------------------------------------------------------------------


def _profile(options: dict):
    choice, wanted = sheet_choice(options), wanted_columns(options.get("usecols"))
    header_row, start, end = row_window(options)

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                header, filled = {}, Counter()
                for number, cells in sheet_rows(content.as_py(), choice, wanted):
                    if number == header_row:
                        header = cells
                    elif start <= number <= end:
                        filled.update(i for i, text in cells.items() if text.strip())
                width = max([*header, *filled], default=-1) + 1
                names = _header_names(header, wanted, width)
                yield pa.RecordBatch.from_pydict(
                    {"header": [list(names.values())], "filled": [[filled[i] for i in names]]},
                    schema=pa.schema([("header", pa.list_(pa.string())), ("filled", pa.list_(pa.int64()))]),
                )

    return run


def _rows(options: dict, columns: list[str]):
    choice, wanted = sheet_choice(options), wanted_columns(options.get("usecols"))
    header_row, start, end = row_window(options)
    schema = pa.schema([(PATH_COLUMN, pa.string()), ("cells", pa.list_(pa.string()))])

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                places, header, pending = None, {}, []
                for number, cells in sheet_rows(content.as_py(), choice, wanted):
                    if number == header_row:
                        header = cells
                    if not start <= number <= end:
                        continue
                    if places is None:
                        # a header never follows its data, so names are settled at the first data row
                        names = _header_names(header, wanted, 16384)
                        by_name = {name: index for index, name in names.items()}
                        places = [by_name.get(name) for name in columns]
                    row = [cells.get(place) for place in places]
                    if any(text is not None and text.strip() for text in row):
                        pending.append(row)
                    if len(pending) == _BATCH:
                        yield pa.RecordBatch.from_pydict({PATH_COLUMN: [path.as_py()] * _BATCH, "cells": pending}, schema)
                        pending = []
                if pending:
                    yield pa.RecordBatch.from_pydict({PATH_COLUMN: [path.as_py()] * len(pending), "cells": pending}, schema)

    return run


def read_workbooks(files: DataFrame, options: dict) -> DataFrame:
    """``files`` has ``path`` and ``content``. All cells come back as text, blank rows and blank columns left out;
    columns are matched by name between workbooks. The path of each row is in ``__path``."""
    row_window(options)
    ship_package(files.sparkSession)
    drift = options.get("drift", "error")
    profile = files.select("content").mapInArrow(_profile(options), "header array<string>, filled array<bigint>")
    per_header = (
        profile.select("header", F.posexplode(F.arrays_zip("header", "filled")).alias("pos", "cell"))
        .groupBy("header", "pos", F.col("cell.header").alias("name"))
        .agg(F.sum("cell.filled").alias("filled"))
        .orderBy("header", "pos")
        .collect()
    )
    filled: dict[str, int] = Counter()
    layouts: dict[tuple, list[str]] = {}
    for row in per_header:
        filled[row["name"]] += row["filled"]
        layouts.setdefault(tuple(row["header"]), []).append(row["name"])
    used = [tuple(n for n in names if filled[n]) for names in layouts.values()]
    if drift != "allow" and len({frozenset(names) if drift == "by_name" else names for names in used}) > 1:
        raise ValueError(f"columns differ between workbooks: {[list(names) for names in used]}")
    columns = [name for name in dict.fromkeys(n for names in used for n in names)]
    rows = files.select("path", "content").mapInArrow(
        _rows(options, columns), f"{PATH_COLUMN} string, cells array<string>"
    )
    return rows.select(*[F.col("cells")[i].alias(name) for i, name in enumerate(columns)], col(PATH_COLUMN))
