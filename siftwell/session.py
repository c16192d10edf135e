"""The session that the engine expects: UTC, ANSI, adaptive execution, bounded Arrow batches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "siftwell", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
