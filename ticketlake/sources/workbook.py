"""Spreadsheet files (.xlsx) decoded by many tasks, one workbook per task step.

Only the cell decoding is Python; listing, distribution and everything after the
decoded cells is Spark.
"""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import time
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.functions.columns import file_name, file_path
from ticketlake.spec import ORIGIN, PATH

CELLS_SCHEMA = (
    f"{PATH} string, {ORIGIN} string, dt_chegada timestamp_ntz, nr_linha long, "
    "celulas array<string>, ds_erro string, tm_leitura double, ds_sha256 string"
)
# Columns that tell the sheet of a file, by name or by position.
SHEET, SHEET_NO = "_aba", "_aba_nr"
_ROWS_PER_BATCH = 5_000
_RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Built-in number formats that show a date or a time.
_DATE_FORMAT_IDS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _texts(node: ElementTree.Element) -> str:
    """Text of a string item: plain or in runs, without phonetic hints."""
    parts = []
    for child in node:
        if _local(child.tag) == "t":
            parts.append(child.text or "")
        elif _local(child.tag) == "r":
            parts.extend(t.text or "" for t in child if _local(t.tag) == "t")
    return "".join(parts)


def _elements(book: zipfile.ZipFile, part: str, tag: str) -> Iterator[ElementTree.Element]:
    if part not in book.namelist():
        return
    with book.open(part) as stream:
        for _, node in ElementTree.iterparse(stream):
            if _local(node.tag) == tag:
                yield node
                node.clear()


def _is_date_format(code: str) -> bool:
    plain = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code)
    return bool(re.search(r"[dmyhs]", plain, re.IGNORECASE))


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell styles that show dates."""
    part = "xl/styles.xml"
    if part not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read(part))
    custom = {}
    styles: set[int] = set()
    for section in root:
        if _local(section.tag) == "numFmts":
            for fmt in section:
                custom[int(fmt.get("numFmtId"))] = _is_date_format(fmt.get("formatCode", ""))
    for section in root:
        if _local(section.tag) == "cellXfs":
            for index, style in enumerate(section):
                fmt_id = int(style.get("numFmtId", "0"))
                if custom.get(fmt_id, fmt_id in _DATE_FORMAT_IDS):
                    styles.add(index)
    return styles


def _sheet_part(book: zipfile.ZipFile, sheet: str | int) -> tuple[str, bool]:
    """Package part of a sheet (by name or position) and the 1904 date flag."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    sheets: list[tuple[str, str]] = []
    from_1904 = False
    for node in root.iter():
        if _local(node.tag) == "sheet":
            sheets.append((node.get("name", ""), node.get(_RELATION_ID, "")))
        elif _local(node.tag) == "workbookPr":
            from_1904 = node.get("date1904", "0") in ("1", "true")
    if isinstance(sheet, int):
        if sheet >= len(sheets):
            raise ValueError(f"a pasta de trabalho não tem a aba número {sheet}")
        wanted = sheets[sheet][1]
    else:
        matches = [relation for name, relation in sheets if name == sheet]
        if not matches:
            raise ValueError(f"aba {sheet!r} não encontrada")
        wanted = matches[0]
    relations = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    for relation in relations:
        if relation.get("Id") == wanted:
            target = relation.get("Target", "")
            return (
                target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}"),
                from_1904,
            )
    raise ValueError(f"aba {sheet!r} sem conteúdo")


def _column_index(reference: str) -> int:
    index = 0
    for letter in reference:
        if not letter.isalpha():
            break
        index = index * 26 + ord(letter.upper()) - ord("A") + 1
    return index - 1


def _number_text(text: str, is_date: bool, from_1904: bool) -> str:
    number = float(text)
    if not is_date:
        return str(int(number)) if number.is_integer() else repr(number)
    if 0 <= number < 1 and not from_1904:
        return str((dt.datetime.min + dt.timedelta(seconds=round(number * 86400))).time())
    # Day 60 of the 1900 system is a 29 February that never was.
    epoch = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 30)
    if not from_1904 and number < 60:
        number += 1
    moment = epoch + dt.timedelta(days=int(number))
    moment += dt.timedelta(milliseconds=round((number - int(number)) * 86_400_000))
    return str(moment)


def _cell_text(
    cell: ElementTree.Element, shared: list[str], dates: set[int], from_1904: bool
) -> str | None:
    kind = cell.get("t", "n")
    value = next((child.text for child in cell if _local(child.tag) == "v"), None)
    if kind == "inlineStr":
        return next((_texts(c) for c in cell if _local(c.tag) == "is"), None)
    if value is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind == "n":
        return _number_text(value, int(cell.get("s", "0")) in dates, from_1904)
    if kind == "d":
        return value.replace("T", " ")
    return value


def sheet_rows(content: bytes, sheet: str | int) -> Iterator[list[str | None]]:
    """All rows of a sheet from the first one on; trailing blank rows are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        part, from_1904 = _sheet_part(book, sheet)
        shared = [_texts(node) for node in _elements(book, "xl/sharedStrings.xml", "si")]
        dates = _date_styles(book)
        emitted = 0
        for row in _elements(book, part, "row"):
            cells: list[str | None] = []
            for cell in row:
                index = _column_index(cell.get("r", "")) if cell.get("r") else len(cells)
                cells.extend([None] * (index + 1 - len(cells)))
                cells[index] = _cell_text(cell, shared, dates, from_1904) or None
            while cells and cells[-1] is None:
                cells.pop()
            if not cells:
                continue
            number = int(row.get("r", emitted + 1))
            while emitted < number - 1:
                emitted += 1
                yield []
            emitted += 1
            yield cells


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Task body: files in, rows out; row 0 is the header, row -1 closes a file with its
    error, the seconds it took and its digest."""

    def frame(file, rows, first):
        return pd.DataFrame(
            {
                PATH: file[PATH],
                ORIGIN: file[ORIGIN],
                "dt_chegada": file["dt_chegada"],
                "nr_linha": range(first, first + len(rows)),
                "celulas": rows,
                "ds_erro": None,
                "tm_leitura": None,
                "ds_sha256": None,
            }
        )

    def decoded(file):
        name = file[ORIGIN]
        if not name.lower().endswith(".xlsx"):
            raise ValueError("formato .xls antigo não é suportado; use .xlsx")
        first, rows = 0, []
        sheet = file[SHEET] if file[SHEET] is not None else int(file[SHEET_NO])
        try:
            for row in sheet_rows(file["content"], sheet):
                rows.append(row)
                if len(rows) == _ROWS_PER_BATCH:
                    yield frame(file, rows, first)
                    first, rows = first + len(rows), []
        except Exception as error:  # any damage fails this file, not the job
            raise ValueError(f"planilha ilegível: {error}") from error
        if first == 0 and not rows:
            rows.append([])
        if rows:
            yield frame(file, rows, first)

    for batch in batches:
        for file in batch.to_dict("records"):
            started, error = time.perf_counter(), None
            try:
                yield from decoded(file)
            except ValueError as damage:
                error = str(damage)
            close = frame(file, [None], -1)
            yield close.assign(
                ds_erro=error, tm_leitura=time.perf_counter() - started, ds_sha256=file["ds_sha256"]
            )


def decode_workbooks(files: DataFrame, sheet: str | int | None) -> DataFrame:
    """Cells of workbook files; ``files`` has path, name, arrival time and ``content``.

    Without ``sheet`` the columns ``_aba`` and ``_aba_nr`` name it per file.
    """
    if sheet is not None:
        name, number = (sheet, None) if isinstance(sheet, str) else (None, sheet)
        files = files.withColumns({SHEET: F.lit(name).cast("string"), SHEET_NO: F.lit(number).cast("int")})
    digest = F.sha2("content", 256).alias("ds_sha256")
    wanted = files.select(PATH, ORIGIN, "dt_chegada", "content", SHEET, SHEET_NO, digest)
    return wanted.mapInPandas(_decode, CELLS_SCHEMA)


def workbook_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Spreadsheet files with their content, not looking into subfolders."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{[xX][lL][sS],[xX][lL][sS][xX]}")
        .load(path)
        .select(
            file_path().alias(PATH),
            file_name().alias(ORIGIN),
            F.col("modificationTime").cast("timestamp_ntz").alias("dt_chegada"),
            "length",
            "content",
        )
    )
