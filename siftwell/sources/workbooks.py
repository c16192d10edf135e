"""XLSX workbooks with the standard library alone (A-3, A-4, B-10)."""

from __future__ import annotations

import io
import os
import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
#: What the format holds in one sheet.
MOST_ROWS = 1_048_576
#: Control characters that XML cannot hold.
_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def column_name(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def cells(data: bytes) -> Iterator[tuple[int, list[str | None]]]:
    """(row number from 1, cells as texts) of the first sheet; gaps are null."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            for _, e in ElementTree.iterparse(z.open("xl/sharedStrings.xml")):
                if e.tag == f"{_MAIN}si":
                    shared.append("".join(t.text or "" for t in e.iter(f"{_MAIN}t")))
                    e.clear()
        sheet = min(n for n in names if n.startswith("xl/worksheets/") and n.endswith(".xml"))
        for _, e in ElementTree.iterparse(z.open(sheet)):
            if e.tag != f"{_MAIN}row":
                continue
            row: list[str | None] = []
            for c in e.iter(f"{_MAIN}c"):
                at = _column(c.get("r", "")) if c.get("r") else len(row)
                row += [None] * (at + 1 - len(row))
                if c.get("t") == "inlineStr":
                    row[at] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                elif (v := c.find(f"{_MAIN}v")) is not None and v.text is not None:
                    row[at] = shared[int(v.text)] if c.get("t") == "s" else v.text
            yield int(e.get("r", "0")), row
            e.clear()


def read(spark: SparkSession, path: str) -> DataFrame:
    """path, row_no, cells: a row per row of each workbook under path; files are read by different tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = list(cells(data.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array([n for n, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.list_(pa.string()))], names=["path", "row_no", "cells"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content").mapInArrow(run, "path string, row_no int, cells array<string>")


def baseline_rows(rows: DataFrame, width: int = 65, first: int = 3) -> DataFrame:
    """A-3: rows from the third on, cut or padded to width; blank ones go."""
    padded = F.slice(F.concat("cells", F.array_repeat(F.lit(None).cast("string"), width)), 1, width)
    return rows.filter(F.col("row_no") >= first).withColumn("cells", padded).filter(F.exists("cells", lambda c: F.coalesce(c, F.lit("")) != ""))


def reference_list(rows: DataFrame, name: int = 7, province: int = 40, city: int = 41, first: int = 3) -> DataFrame:
    """A-4: name, province and city by position (from 0); the first row of a name wins."""
    cell = lambda i: F.coalesce(F.trim(F.get("cells", F.lit(i))), F.lit(""))
    out = rows.filter(F.col("row_no") >= first).select("path", "row_no", cell(name).alias("name"), cell(province).alias("province"), cell(city).alias("city")).filter("name <> ''")
    return out.withColumn("_r", F.row_number().over(Window.partitionBy("name").orderBy("path", "row_no"))).filter("_r = 1").drop("_r", "path", "row_no")


def _row(n: int, values: Iterable) -> str:
    out = []
    for i, v in enumerate(values):
        if v is None or v == "":
            continue
        ref = f"{column_name(i)}{n}"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            out.append(f'<c r="{ref}"><v>{v}</v></c>')
        else:
            out.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(_BAD.sub("", str(v)))}</t></is></c>')
    return f'<row r="{n}">{"".join(out)}</row>'


def write(df: DataFrame, path: str, order: list[str], groups: list[tuple[str, int]] | None = None, links: str | None = None, title: str = "Sheet1") -> int:
    """B-10: one workbook in a local path, rows in the given order: merged group titles, headers, frozen and filtered; the file appears
    whole or not at all. Rows stream through the driver one partition at a time; more than a sheet holds is an error before writing.
    links: a column of addresses that become hyperlinks. Returns the rows written."""
    n = df.count()
    if n + 2 > MOST_ROWS:
        raise ValueError(f"{n} rows don't fit in a sheet of {MOST_ROWS}; write Parquet or CSV")
    groups = groups or [(title, len(df.columns))]
    top, merged, at = [], [], 0
    for label, size in groups:
        top += [label] + [None] * (size - 1)
        if size > 1:
            merged.append(f"{column_name(at)}1:{column_name(at + size - 1)}1")
        at += size
    part, refs = f"{path}.part", []
    with zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        pack = "http://schemas.openxmlformats.org/package/2006/relationships"
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="{pack}"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{rel}"><sheets><sheet name={quoteattr(title)} sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="{pack}"><Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as f:
            put = lambda s: f.write(s.encode())
            put(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN[1:-1]}" xmlns:r="{rel}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="2" topLeftCell="A3" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><sheetData>')
            put(_row(1, top) + _row(2, df.columns))
            for i, r in enumerate(df.orderBy(*order).toLocalIterator()):
                put(_row(i + 3, r))
                if links and r[links]:
                    refs.append((f"{column_name(df.columns.index(links))}{i + 3}", r[links]))
            put(f'</sheetData><autoFilter ref="A2:{column_name(len(df.columns) - 1)}{n + 2}"/>')
            if merged:
                put(f'<mergeCells count="{len(merged)}">' + "".join(f'<mergeCell ref="{m}"/>' for m in merged) + "</mergeCells>")
            if refs:
                put("<hyperlinks>" + "".join(f'<hyperlink ref="{at}" r:id="h{i}"/>' for i, (at, _) in enumerate(refs)) + "</hyperlinks>")
            put("</worksheet>")
        if refs:
            z.writestr("xl/worksheets/_rels/sheet1.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="{pack}">' + "".join(f'<Relationship Id="h{i}" Type="{rel}/hyperlink" Target={quoteattr(_BAD.sub("", u))} TargetMode="External"/>' for i, (_, u) in enumerate(refs)) + "</Relationships>")
    os.replace(part, path)
    return n
