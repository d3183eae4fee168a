"""Tabular files: CSV through Spark's reader, workbooks as one task per file."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ElementTree
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serieslake.functions.numeric import clean_double
from serieslake.functions.text import blank_to_null
from serieslake.schema import VALUE, UnsupportedFileTypeError

# XML namespaces of the workbook format.
SHEET_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def read_tabular(
    spark: SparkSession, path: str, *, sheet: str | int = 0, columns: Sequence[str] | None = None
) -> DataFrame:
    """All-text frame from CSV files or workbooks; a folder or pattern reads many files."""
    suffix = path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    if suffix == "csv":
        return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    if suffix in ("xlsx", "xls"):
        return read_workbooks(spark, path, sheet=sheet, columns=columns)
    raise UnsupportedFileTypeError(f"no reader for {path!r}; use .csv, .xlsx or .xls")


def strip_text(frame: DataFrame) -> DataFrame:
    """Every text column trimmed; what is left empty becomes NULL."""
    return frame.select(
        *[
            blank_to_null(F.col(f"`{field.name}`")).alias(field.name)
            if isinstance(field.dataType, T.StringType)
            else F.col(f"`{field.name}`")
            for field in frame.schema
        ]
    )


def coerce_values(frame: DataFrame, column: str = VALUE) -> DataFrame:
    """The value column as a number; sentinel text such as "N/A" becomes NULL."""
    return frame.withColumn(column, clean_double(F.col(column)))


def coercion_report(frame: DataFrame, column: str = VALUE) -> DataFrame:
    """(text, n): the texts that are no number and how often each occurs."""
    lost = clean_double(F.col(column)).isNull() & F.col(column).isNotNull()
    return frame.filter(lost).groupBy(F.col(column).cast("string").alias("text")).agg(
        F.count("*").alias("n")
    )


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def workbook_rows(content: bytes, sheet: str | int = 0) -> list[list[str | None]]:
    """Cell texts of one sheet. The older binary format needs pandas' optional reader."""
    if not zipfile.is_zipfile(io.BytesIO(content)):
        table = pd.read_excel(io.BytesIO(content), sheet_name=sheet, header=None, dtype=str)
        return table.astype(object).where(table.notna(), None).values.tolist()
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")):
                shared.append("".join(node.text or "" for node in item.iter(f"{SHEET_NS}t")))
        sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{SHEET_NS}sheets")
        links = {
            link.get("Id"): link.get("Target")
            for link in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        }
        chosen = (
            sheets[sheet]
            if isinstance(sheet, int)
            else next(node for node in sheets if node.get("name") == sheet)
        )
        target = links[chosen.get(f"{RELATION_NS}id")].lstrip("/")
        target = target if target.startswith("xl/") else f"xl/{target}"
        rows = []
        for row in ElementTree.fromstring(book.read(target)).iter(f"{SHEET_NS}row"):
            cells: dict[int, str | None] = {}
            for cell in row.iter(f"{SHEET_NS}c"):
                kind = cell.get("t")
                if kind == "inlineStr":
                    text = "".join(node.text or "" for node in cell.iter(f"{SHEET_NS}t"))
                else:
                    node = cell.find(f"{SHEET_NS}v")
                    text = None if node is None else node.text
                    if kind == "s" and text is not None:
                        text = shared[int(text)]
                cells[_column_index(cell.get("r"))] = text
            rows.append([cells.get(i) for i in range(max(cells) + 1)] if cells else [])
        return rows


def _header_names(books: DataFrame, sheet: str | int) -> list[str]:
    """The distinct column names of all workbooks, found where the files are read."""

    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                header = next(iter(workbook_rows(content, sheet)), [])
                names = [str(c).strip() for c in header if c]
                if names:
                    yield pd.DataFrame({"path": path, "place": range(len(names)), "name": names})

    found = books.mapInPandas(headers, "path string, place int, name string")
    first = found.groupBy("name").agg(F.min(F.struct("path", "place")).alias("at"))
    return [row["name"] for row in first.orderBy("at").collect()]


def read_workbooks(
    spark: SparkSession, path: str, *, sheet: str | int = 0, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of many workbooks, all text. Each workbook is opened by one task; the format caps
    a sheet at about a million rows. Columns default to those of all headers, in order of path and
    place; only names reach the driver."""
    books = spark.read.format("binaryFile").load(path).select("path", "content")
    names = _header_names(books, sheet) if columns is None else list(columns)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                header, *rows = workbook_rows(content, sheet) or [[]]
                places = {str(c).strip(): i for i, c in enumerate(header) if c is not None}
                yield pd.DataFrame(
                    {
                        name: [
                            row[places[name]] if name in places and places[name] < len(row) else None
                            for row in rows
                        ]
                        for name in names
                    },
                    dtype="object",
                )

    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return books.select("content").mapInPandas(parse, schema)
