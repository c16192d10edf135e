"""The ledger of runs (L-5 to L-7, M-22): append-only rows, of which the latest of a run counts. Times are given, never taken from a clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.operators.latest import first_by

SCHEMA = "task_id string, task_type string, status string, at timestamp, total long, failed long, error string"


def latest(log: DataFrame) -> DataFrame:
    """A row a run; at equal times what is finished counts."""
    return first_by(log, ["task_id"], [F.col("at").desc_nulls_last(), (F.col("status") == "running").asc(), F.col("status").asc()])


def finished(task_id: str, task_type: str, at: dt.datetime, total: int, failed: int, error: str | None = None) -> tuple:
    """L-6: the row that ends a run; it has failed only if there is an error."""
    return (task_id, task_type, "failed" if error else "success", at, total, failed, error)


def stale(log: DataFrame, now: dt.datetime, seconds: int) -> DataFrame:
    """L-5: rows that end, as failed, the runs still running after so long; to be appended."""
    old = latest(log).filter((F.col("status") == "running") & (F.col("at") < F.lit(now - dt.timedelta(seconds=seconds))))
    return old.withColumns({"status": F.lit("failed"), "at": F.lit(now).cast("timestamp"), "error": F.lit("stale")}).select(*log.columns)


def recent(log: DataFrame, n: int, task_type: str | None = None) -> DataFrame:
    """M-22: the n latest runs (G-3)."""
    known = latest(log)
    return (known.filter(F.col("task_type") == task_type) if task_type else known).orderBy(F.col("at").desc_nulls_last(), "task_id").limit(n)


def stable(log: DataFrame, task_type: str, rows: int | None = None, enough: int | None = None) -> bool:
    """L-7: whether the type's latest run succeeded with no failed item, or its table has enough rows, where that counts."""
    if rows is not None and enough is not None and rows >= enough:
        return True
    last = recent(log, 1, task_type).select("status", "failed").first()
    return last is not None and last.status == "success" and not last.failed
