"""Spreadsheet workbooks (.xlsx) read in tasks, one workbook at a time."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import col
from tabulon.sources.delimited import MISSING_TEXTS

# Namespaces of the workbook format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"
#: Rows handed over at a time.
CHUNK = 5000


def _sheet_file(book: zipfile.ZipFile, sheet: str | None) -> str:
    """Path of the named sheet, or of the first one."""
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(
        book.read("xl/_rels/workbook.xml.rels")).iter(f"{_PKG}Relationship")}
    for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
        if sheet is None or s.get("name") == sheet:
            target = targets[s.get(f"{_REL}id")]
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError(f"no sheet {sheet}")


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in si.iter(f"{_MAIN}t"))
            for si in root.iter(f"{_MAIN}si")]


def _column_number(reference: str) -> int:
    n = 0
    for ch in reference:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - ord("A") + 1
    return n - 1


def _rows(content: bytes, sheet: str | None) -> Iterator[dict[int, str | None]]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        texts = _shared_texts(book)
        with book.open(_sheet_file(book, sheet)) as f:
            data = None
            for event, row in ElementTree.iterparse(f, ("start", "end")):
                if event == "start" and row.tag == f"{_MAIN}sheetData":
                    data = row
                if event == "start" or row.tag != f"{_MAIN}row":
                    continue
                cells: dict[int, str | None] = {}
                for at, c in enumerate(row.iter(f"{_MAIN}c")):
                    where = _column_number(c.get("r")) if c.get("r") else at
                    kind = c.get("t")
                    if kind == "inlineStr":
                        value = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    else:
                        v = c.find(f"{_MAIN}v")
                        value = v.text if v is not None else None
                        if kind == "s" and value is not None:
                            value = texts[int(value)]
                    cells[where] = value
                yield cells
                data.clear()        # the rows read so far, and not only what is in them


def workbook_rows(files: DataFrame, schema: T.StructType | str, sheet: str | None = None,
                  missing: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    """Rows of the workbooks in ``files`` (path, content), columns found by header name."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in schema.fields]
    raw = T.StructType([T.StructField(n, T.StringType()) for n in names])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = _rows(content, sheet)
                header = {v: i for i, v in next(rows, {}).items()}
                at = [header.get(n) for n in names]
                held: list[list[str | None]] = []
                for cells in rows:
                    held.append([cells.get(i) if i is not None else None for i in at])
                    if len(held) == CHUNK:
                        yield pd.DataFrame(held, columns=names, dtype=object)
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=names, dtype=object)

    text = files.select("content").mapInPandas(parse, raw)
    out = []
    for f in schema.fields:
        value = F.when(~col(f.name).isin(list(missing)), col(f.name))
        if not isinstance(f.dataType, T.StringType):
            if isinstance(f.dataType, T.IntegralType):      # numbers are stored as 3 or 3.0
                value = value.try_cast("double")
            value = value.try_cast(f.dataType)
        out.append(value.alias(f.name))
    return text.select(*out)


def read_workbooks(spark: SparkSession, path: str, schema: T.StructType | str,
                   sheet: str | None = None) -> DataFrame:
    """Rows of every .xlsx file in a folder; one task per workbook at most."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
             .select("path", "content"))
    return workbook_rows(files, schema, sheet)
