"""Cells of a workbook sheet as rows, without a spreadsheet library: an .xlsx file is a zip of XML parts."""

from __future__ import annotations

import re
import zipfile
from pathlib import Path
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the namespaces of the format
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINKS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
SCHEMA = "cell string, row int, col int, value string, is_formula boolean"
MOST_CELLS = 1_000_000


class WorkbookError(ValueError):
    pass


def column_number(letters: str) -> int:
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n


def _text(node: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{MAIN}t"))


def cells(path: str | Path, sheet: str) -> list[tuple[str, int, int, str | None, bool]]:
    """(cell, row, col, value, is_formula) of the filled cells; a formula without a saved result has no value."""
    try:
        book = zipfile.ZipFile(path)
        index = ElementTree.fromstring(book.read("xl/workbook.xml"))
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as error:
        raise WorkbookError("not a readable workbook") from error
    with book:
        named = {s.get("name"): links.get(s.get(f"{LINKS}id")) for s in index.iter(f"{MAIN}sheet")}
        if not named.get(sheet):
            raise WorkbookError(f"there is no sheet {sheet!r}")
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_text(s) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")]
        part = named[sheet].lstrip("/")  # type: ignore[union-attr]
        root = ElementTree.fromstring(book.read(part if part.startswith("xl/") else f"xl/{part}"))
    out: list[tuple[str, int, int, str | None, bool]] = []
    for c in root.iter(f"{MAIN}c"):
        at = re.fullmatch(r"([A-Z]+)([0-9]+)", c.get("r", ""))
        if not at:
            raise WorkbookError("a cell has no place")
        raw, formula = c.find(f"{MAIN}v"), c.find(f"{MAIN}f") is not None
        kind = c.get("t")
        value = _text(c) if kind == "inlineStr" else raw.text if raw is not None else None
        if kind == "s" and value is not None:
            value = shared[int(value)]
        if value is not None or formula:
            out.append((at[0], int(at[2]), column_number(at[1]), value, formula))
        if len(out) > MOST_CELLS:
            raise WorkbookError(f"over {MOST_CELLS} cells")
    return out


def grid(spark: SparkSession, path: str | Path, sheet: str) -> DataFrame:
    return spark.createDataFrame(cells(path, sheet), SCHEMA)


def cross_foot(grid: DataFrame, rows: tuple[int, int], cols: tuple[int, int], total_row: int, total_col: int) -> DataFrame:
    """(axis, at, summed, stated): each row and column whose stated total isn't the sum of its cells; blanks and dashes are 0."""
    plain = F.regexp_replace(F.trim("value"), ",", "")
    number = F.when(F.col("value").isNull() | plain.isin("", "-", "–"), F.lit(0)).otherwise(plain.try_cast("double").cast("bigint"))
    inside = F.col("row").between(*rows) & F.col("col").between(*cols)
    # the body once by column, once by row; the stated totals beside them
    sides = F.array(
        F.struct(F.lit("column").alias("axis"), F.col("col").alias("at"), F.when(inside, number).alias("part"), F.when((F.col("row") == total_row) & F.col("col").between(*cols), number).alias("total")),
        F.struct(F.lit("row").alias("axis"), F.col("row").alias("at"), F.when(inside, number).alias("part"), F.when((F.col("col") == total_col) & F.col("row").between(*rows), number).alias("total")),
    )
    sums = grid.select(F.explode(sides).alias("s")).select("s.*").where("part is not null or total is not null").groupBy("axis", "at").agg(F.coalesce(F.sum("part"), F.lit(0)).alias("summed"), F.coalesce(F.max("total"), F.lit(0)).alias("stated"))
    return sums.where("summed <> stated")
