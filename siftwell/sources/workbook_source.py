"""Workbooks as a data source (A-3): ``spark.read.format("workbook").load(folder)``.

Its readers are Python and reach what pyarrow does (local and mounted folders, HDFS, S3, GCS by their URI). Each file is a task, or,
with the option rowsPerTask, each so many rows by the sheet's stated dimension; the last range takes what goes beyond it.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siftwell.sources import workbooks


@dataclass
class Rows(InputPartition):
    """A file's rows from `first` to before `end`; all from it on where that is None."""

    uri: str
    first: int = 1
    end: int | None = None


def _open(uri: str) -> bytes:
    store, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    with store.open_input_stream(path) as f:
        return f.readall()


def files(top: str) -> list[str]:
    """The workbooks of a folder, or the file itself; as they were given, with or without a scheme."""
    given = re.match(r"[a-z0-9+.-]+://[^/]*|file:", top, re.I)
    store, path = fs.FileSystem.from_uri(top) if given else (fs.LocalFileSystem(), top)
    info = store.get_file_info([path])[0]
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=True))
    prefix = (given[0] if "://" in given[0] else "file://") if given else ""
    names = sorted(x.path for x in found if x.type == fs.FileType.File and x.path.endswith(".xlsx"))
    return [f"{prefix.rstrip('/')}/{x.lstrip('/')}" if given else x for x in names]


def stated_rows(data: bytes) -> int:
    """The last row by the first sheet's dimension; 0 if it states none."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        sheet = min(n for n in z.namelist() if n.startswith("xl/worksheets/") and n.endswith(".xml"))
        m = re.search(rb'<dimension ref="[A-Z]+\d+:[A-Z]+(\d+)"', z.open(sheet).read(4096))
    return int(m[1]) if m else 0


class WorkbookReader(DataSourceReader):
    def __init__(self, options):
        self.top, self.rows = options.get("path") or "", int(options.get("rowsPerTask") or 0)
        if not self.top:
            raise ValueError("a workbook source needs a path")

    def partitions(self) -> list[Rows]:
        out = []
        for uri in files(self.top):
            starts = range(1, max(2, stated_rows(_open(uri)) + 1), self.rows) if self.rows else [1]
            out += [Rows(uri, a, a + self.rows if k + 1 < len(starts) else None) for k, a in enumerate(starts)]
        return out

    def read(self, partition: Rows) -> Iterator[tuple]:
        for n, cells in workbooks.cells(_open(partition.uri)):
            if partition.end is not None and n >= partition.end:
                return
            if n >= partition.first:
                yield partition.uri, n, cells


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return "path string, row_no int, cells array<string>"

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WorkbookSource)
