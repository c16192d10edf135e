"""Heartbeats of streams (O-8): a listener that notes a stream's progress and its end in the ledger of runs."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from siftwell.operators import ledger


class Heartbeat(StreamingQueryListener):
    """Writes ledger rows as small JSON files under `path`, in the store that Spark writes to.

    A stream is a run: its task_id is the query's runId, its task_type its name or `task_type`. A beat is noted at most every
    `seconds` of event time, the end always; errors by their class, never by what they say.
    """

    def __init__(self, spark: SparkSession, path: str, task_type: str = "stream", seconds: int = 120):
        self.spark, self.path, self.task_type, self.seconds = spark, path.rstrip("/"), task_type, seconds
        self.beats: dict[str, dt.datetime] = {}
        self.totals: dict[str, int] = {}
        self.names: dict[str, str] = {}

    def note(self, run: str, status: str, at: dt.datetime, error: str | None = None) -> None:
        row = {"task_id": run, "task_type": self.names.get(run) or self.task_type, "status": status, "at": at.isoformat(), "total": self.totals.get(run, 0), "failed": 0, "error": error}
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{uuid.uuid4().hex}.json")
        out = hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop, False)
        out.write(bytearray(json.dumps(row, ensure_ascii=False).encode()))
        out.close()

    @staticmethod
    def moment(text: str) -> dt.datetime:
        return dt.datetime.fromisoformat(text.replace("Z", "+00:00"))

    def onQueryStarted(self, event) -> None:  # noqa: N802
        run, at = str(event.runId), self.moment(event.timestamp)
        self.names[run], self.beats[run] = event.name, at
        self.note(run, "running", at)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.beat(str(event.progress.runId), event.progress.timestamp, event.progress.numInputRows)

    def beat(self, run: str, timestamp: str, rows: int) -> None:
        at = self.moment(timestamp)
        self.totals[run] = self.totals.get(run, 0) + rows
        if run not in self.beats or (at - self.beats[run]).total_seconds() >= self.seconds:
            self.beats[run] = at
            self.note(run, "running", at)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self.beat(str(event.runId), event.timestamp, 0)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        run, now = str(event.runId), dt.datetime.now(dt.timezone.utc)
        error = (event.errorClassOnException or "error") if event.exception else None
        self.note(run, "failed" if error else "success", max(now, self.beats.get(run, now)), error)
        for held in (self.beats, self.totals, self.names):
            held.pop(run, None)


def ledger_rows(spark: SparkSession, path: str) -> DataFrame:
    """The ledger that heartbeats have written, for `operators.ledger`."""
    return spark.read.schema(ledger.SCHEMA).json(path)
