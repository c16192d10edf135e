"""Loops over tables: the driver counts, the tables stay with the executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where that is unset on one machine (tests)."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not found and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        if not found:
            found = tempfile.mkdtemp(prefix="siftwell-")
            atexit.register(shutil.rmtree, found, True)
        context.setCheckpointDir(found)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The table, written to the checkpoint folder, so that plans of later rounds don't grow and lost executors lose nothing."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
