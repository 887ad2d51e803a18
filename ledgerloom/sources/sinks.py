"""Writing results: tables, sheets, and bundles that are published whole or not at all."""

from __future__ import annotations

import hashlib
import json
import re
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Control characters that no sheet may hold.
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def write_table(df: DataFrame, path: str, kind: str = "parquet", by: list[str] | None = None) -> None:
    """Parquet, CSV or JSON lines, partitioned by `by`; JSON leaves out nulls."""
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    if kind == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif kind == "json":
        writer.option("ignoreNullFields", "true").json(path)
    else:
        writer.parquet(path)


def sheet_order(columns: list[str]) -> list[str]:
    """Value columns as sheets show them: totals, budgets, quarters, credits, forecasts, each by year."""
    rank = ("total", "buget_", "trim", "credite", "executie_", "est")

    def place(c: str) -> tuple[int, str, str]:
        year = re.search(r"\d{4}$", c)
        return next((i for i, p in enumerate(rank) if c.startswith(p)), len(rank)), year.group() if year else "", c

    return sorted(columns, key=place)


def sheet_rows(facts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Facts as sheet rows: a column per value column, texts without control characters."""
    wide = facts.groupBy(*keys).pivot("column_name", columns).agg(F.first("value"))
    return wide.select(*[F.regexp_replace(F.col(k).cast("string"), CONTROL, "").alias(k) for k in keys], *sheet_order(columns))


def write_workbook(sheets: dict[str, tuple[list[str], list[tuple]]], path: str, most_rows: int = 1_048_575) -> None:
    """An XLSX file of literal text cells; more rows than a sheet can hold raise."""
    letters = lambda i: (letters(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)
    cell = lambda r, c, v: "" if v is None else f'<c r="{letters(c)}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(re.sub(CONTROL, "", str(v)))}</t></is></c>'
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml", f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        links = "".join(f'<Relationship Id="r{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        listed = "".join(f'<sheet name="{escape(n[:31])}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{listed}</sheets></workbook>')
        for i, (header, rows) in enumerate(sheets.values(), 1):
            if len(rows) > most_rows:
                raise ValueError(f"{len(rows)} rows don't fit a sheet")
            body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row)) + "</row>" for r, row in enumerate([tuple(header), *rows], 1))
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")


def publish(parts: dict[str, bytes], folder: str) -> str:
    """Writes a bundle's parts and, last, the manifest that makes them hold; returns the bundle's id.

    The parts lie in a folder named by their hashes, so an interrupted
    publication leaves the former bundle in place, and the same content is
    published once.
    """
    root = Path(folder)
    hashes = {name: hashlib.sha256(data).hexdigest() for name, data in sorted(parts.items())}
    bundle = hashlib.sha256(json.dumps(hashes, sort_keys=True).encode()).hexdigest()[:24]
    place = root / bundle
    place.mkdir(parents=True, exist_ok=True)
    for name, data in parts.items():
        (place / name).write_bytes(data)
    draft = root / f"{bundle}.draft"
    draft.write_text(json.dumps({"bundle": bundle, "sha256": hashes, "bytes": {n: len(d) for n, d in parts.items()}}, sort_keys=True))
    draft.replace(root / "manifest.json")
    return bundle


def audit(folder: str) -> list[str]:
    """What is wrong with the published bundle: missing parts, other sizes or hashes; empty if all is well."""
    root = Path(folder)
    if not (root / "manifest.json").exists():
        return ["no manifest"]
    told = json.loads((root / "manifest.json").read_text())
    wrong = []
    for name, digest in told["sha256"].items():
        part = root / told["bundle"] / name
        if not part.exists():
            wrong.append(f"missing: {name}")
        elif hashlib.sha256(part.read_bytes()).hexdigest() != digest:
            wrong.append(f"changed: {name}")
    return wrong
