"""Reading staged files: discovery, typed facts, line JSON, page grids, workbooks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.windows import first_wins

FACTS = "municipality string, siruta string, year string, suffix string, section string, kind string, code string, func_code string, column string, value string, verified string, page string"
GRID_CELLS = "path string, grid_table int, row int, col int, cell string"
SHEET_CELLS = "path string, sheet string, row int, col int, cell string"


def discover(spark: SparkSession, folder: str, pattern: str, path_regex: str, groups: dict[str, int]) -> DataFrame:
    """Files under a folder whose names fit `pattern`: path, length, time and the parts of the path `path_regex` names.

    Only the listing is read, not the contents.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")
    parts = {name: F.nullif(F.regexp_extract("path", path_regex, at), F.lit("")) for name, at in groups.items()}
    return listed.withColumns(parts)


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """Exported facts: values that are numbers of 1 or more in size and have a code; the first row of each line counts.

    Rows are ordered by their place in the file.
    """
    raw = spark.read.csv(path, header=True, schema=FACTS, enforceSchema=False)
    keyed = raw.withColumn("_ord", F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id()))
    typed = keyed.withColumn("value", F.col("value").try_cast("decimal(38,6)")).where("abs(value) >= 1 and code is not null and code != ''")
    keys = ["siruta", "suffix", "section", "kind", "code", "func_code", "column"]
    filled = typed.withColumns({k: F.coalesce(k, F.lit("")) for k in keys})
    return first_wins(filled, ["year", *keys], ["_ord"]).drop("_ord").withColumn("verified", F.lower("verified") == "true")


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a known schema; lines that don't parse are kept apart in `_corrupt`."""
    return spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_grids(spark: SparkSession, path: str) -> DataFrame:
    """Stored page grids (text, grid) as (path, row, col, cell)."""
    pages = spark.read.option("multiLine", "true").schema("text string, rotation_applied int, grid array<array<string>>").json(path).withColumn("path", F.col("_metadata.file_path"))
    rows = pages.select("path", F.posexplode("grid").alias("row", "cells"))
    return rows.select("path", "row", F.posexplode("cells").alias("col", "cell"))


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def workbook_cells(content: bytes) -> Iterator[tuple[str, int, int, str]]:
    """(sheet, row, col, text) of an XLSX file: shared and inline strings, numbers as shown by zero-padding formats."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    rel = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        tree = lambda name: ElementTree.fromstring(z.read(name))
        shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in tree("xl/sharedStrings.xml").findall("m:si", ns)] if "xl/sharedStrings.xml" in names else []
        formats: dict[int, str] = {}
        if "xl/styles.xml" in names:
            styles = tree("xl/styles.xml")
            custom = {f.get("numFmtId"): f.get("formatCode") for f in styles.iterfind(".//m:numFmt", ns)}
            formats = {i: custom.get(x.get("numFmtId"), "") for i, x in enumerate(styles.iterfind("m:cellXfs/m:xf", ns))}
        targets = {r.get("Id"): r.get("Target") for r in tree("xl/_rels/workbook.xml.rels")}
        for sheet in tree("xl/workbook.xml").iterfind(".//m:sheet", ns):
            part = targets[sheet.get(rel)]
            part = part.lstrip("/") if part.startswith("/") else f"xl/{part}"
            for row in tree(part).iterfind(".//m:row", ns):
                for c in row.iterfind("m:c", ns):
                    value = c.find("m:v", ns)
                    if c.get("t") == "s" and value is not None:
                        text = shared[int(value.text)]
                    elif c.get("t") == "inlineStr":
                        text = "".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t"))
                    else:
                        text = value.text or "" if value is not None else ""
                        shown = re.fullmatch(r"(0+)\.(0+)", formats.get(int(c.get("s") or 0), ""))
                        if shown and re.fullmatch(r"-?\d+(\.\d+)?", text):
                            text = f"{float(text):0{len(shown.group())}.{len(shown.group(2))}f}"
                    if text:
                        yield sheet.get("name"), int(row.get("r")) - 1, _column(c.get("r")), text


def _workbooks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf.path, pdf.content, strict=True):
            try:
                rows = [(path, *cell) for cell in workbook_cells(content)]
            except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                rows = [(path, None, None, None, None)]
            yield pd.DataFrame(rows, columns=["path", "sheet", "row", "col", "cell"]).astype({"row": "Int32", "col": "Int32"})


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """Cells of all XLSX files under a path; a file that is none gives one row of nulls, so it isn't lost."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInPandas(_workbooks, SHEET_CELLS)
