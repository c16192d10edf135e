"""HTML tables as rows (A-5, I-20): one row per table row, with header cells apart."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows, self.stack, self.n = [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.stack.append({"no": self.n, "class": dict(attrs).get("class") or "", "row": 0, "cells": None, "cell": None, "head": False})
            self.n += 1
        elif self.stack and tag == "tr":
            self._close_row()
            self.stack[-1].update(cells=[], head=False)
        elif self.stack and tag in ("td", "th"):
            self._close_cell()
            t = self.stack[-1]
            if t["cells"] is None:
                t["cells"] = []
            t["cell"], t["head"] = [], t["head"] or tag == "th"

    def _close_cell(self):
        t = self.stack[-1]
        if t["cell"] is not None:
            t["cells"].append("".join(x.strip() for x in t["cell"]))
            t["cell"] = None

    def _close_row(self):
        self._close_cell()
        t = self.stack[-1]
        if t["cells"]:
            self.rows.append((t["no"], t["row"], t["cells"], t["head"], t["class"]))
            t["row"] += 1
        t["cells"] = None

    def handle_endtag(self, tag):
        if not self.stack:
            return
        if tag in ("td", "th"):
            self._close_cell()
        elif tag == "tr":
            self._close_row()
        elif tag == "table":
            self._close_row()
            self.stack.pop()

    def handle_data(self, data):
        if self.stack and self.stack[-1]["cell"] is not None:
            self.stack[-1]["cell"].append(data)


def tables(html: str | None) -> list[tuple[int, int, list[str], bool, str]]:
    p = _Tables()
    p.feed(html or "")
    p.close()
    while p.stack:
        p.handle_endtag("table")
    return p.rows


def table_rows(pages: DataFrame, html: str, ident: str) -> DataFrame:
    """ident, table_no, row_no, cells, is_header, table_class."""
    kind = pages.schema[ident].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, *r) for i, h in enumerate(b.column(1)) for r in tables(h.as_py())]
            at = pa.array([x[0] for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), *(pa.array([x[k] for x in found], t) for k, t in ((1, pa.int32()), (2, pa.int32()), (3, pa.list_(pa.string())), (4, pa.bool_()), (5, pa.string())))], names=[ident, "table_no", "row_no", "cells", "is_header", "table_class"])

    return pages.select(ident, html).mapInArrow(run, f"{ident} {kind}, table_no int, row_no int, cells array<string>, is_header boolean, table_class string")


def with_headers(rows: DataFrame, ident: str, expected: list[str]) -> DataFrame:
    """Body rows of tables whose first header row has an expected label, as a map; a later column of a label wins."""
    heads = rows.filter("is_header AND row_no = 0").filter(F.arrays_overlap("cells", F.array(*map(F.lit, expected)))).select(ident, "table_no", F.col("cells").alias("_head"))
    body = rows.filter("NOT is_header").join(heads, [ident, "table_no"])
    n = F.least(F.size("_head"), F.size("cells"))
    pairs = F.arrays_zip(F.slice("_head", F.lit(1), n), F.slice("cells", F.lit(1), n))
    last = F.filter(F.transform(pairs, lambda p, i: F.struct(p["0"].alias("k"), p["1"].alias("v"), i.alias("i"))), lambda x: x.i + 1 == F.size("_head") - F.array_position(F.reverse("_head"), x.k) + 1)
    return body.select(ident, "table_no", "row_no", F.map_from_entries(F.transform(last, lambda x: F.struct(x.k, x.v))).alias("row"))


def label(row: str, *names: str) -> Column:
    """The first of several header synonyms that has a value."""
    return F.coalesce(*[F.nullif(F.trim(F.try_element_at(F.col(row), F.lit(n))), F.lit("")) for n in names])
