"""Incremental ingest (B-9, O-1 to O-3): landing files to the change-data merge, micro-batch by micro-batch.

A table is as many buckets of its key's hash as it was begun with, each in a folder of its own, and a log of manifests that
name every bucket's folder. A batch reads and rewrites only the buckets that its keys fall in, into fresh folders, writes its
snapshots under its stream and number, and then commits the next manifest by a rename that fails if another writer has
made it: of two writers one has to try again, and neither touches what the other writes. A manifest says which batch of each
stream it holds, so a batch that is tried again after its commit does nothing, and one tried again before starts from the table that
stood; readers see whole versions at any time. Folders that a version has replaced stay until the next commit, for
readers that are at them; folders of tries that failed go by `vacuum`.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.operators.merge import EntitySpec, apply_changes


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    return spark.read.text(path, wholetext=True).head().value if fs.exists(p) else None


def current(spark: SparkSession, table: str) -> dict:
    """The last manifest: version, number of buckets, their folders, those it replaced, the last batch of each stream; version -1 without one."""
    fs, top = _fs(spark, f"{table}_pointer")
    found = sorted(x.getPath().getName() for x in fs.listStatus(top) if x.getPath().getName().endswith(".json")) if fs.exists(top) else []
    if not found:
        return {"version": -1, "buckets": None, "folders": {}, "replaced": [], "streams": {}}
    return json.loads(_text(spark, f"{table}_pointer/{found[-1]}"))


def current_version(spark: SparkSession, table: str) -> int:
    return current(spark, table)["version"]


def _point(spark: SparkSession, table: str, state: dict) -> None:
    """Commits a manifest: it is written under another name and renamed to its version's, which must not be there."""
    jvm = spark.sparkContext._jvm
    fs, fresh = _fs(spark, f"{table}_pointer/{uuid.uuid4().hex}.tmp")
    out = fs.create(fresh, True)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    to = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{table}_pointer/{state['version']:012d}.json"))
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(fresh), to, how)


def read(spark: SparkSession, table: str, schema, buckets: list[int] | None = None) -> DataFrame:
    """The table as of its last manifest, or those buckets of it."""
    return _read(spark, table, schema, current(spark, table)["folders"], buckets)


def _read(spark: SparkSession, table: str, schema, folders: dict[str, str], buckets: list[int] | None) -> DataFrame:
    paths = [f"{table}/{folder}" for b, folder in folders.items() if buckets is None or int(b) in buckets]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, table: str, older_than_s: float) -> int:
    """Deletes folders that the last manifest neither names nor has just replaced, if they are older; their number."""
    state, (fs, top) = current(spark, table), _fs(spark, table)
    held = {x.split("/")[0] for x in [*state["folders"].values(), *state["replaced"]]}
    old = [x.getPath() for x in fs.listStatus(top) if x.getPath().getName() not in held and x.getModificationTime() / 1000 < time.time() - older_than_s]
    for path in old:
        fs.delete(path, True)
    return len(old)


def merge_batch(spark: SparkSession, table: str, batch: DataFrame, schema, spec: EntitySpec, buckets: int, seq: str | None, stream: str, number: int) -> dict:
    """One batch into the table; the manifest after it."""
    was = current(spark, table)
    if was["streams"].get(stream, -1) >= number:
        return was  # committed before the stream could note it
    n = was["buckets"] or buckets
    held = []

    def keep(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.DISK_ONLY))
        return held[-1]

    try:
        return _merged(spark, table, batch, schema, spec, n, seq, stream, number, was, keep)
    finally:
        for df in held:
            df.unpersist()


def _merged(spark: SparkSession, table: str, batch: DataFrame, schema, spec: EntitySpec, n: int, seq: str | None, stream: str, number: int, was: dict, keep) -> dict:
    if not seq:
        batch = keep(batch.distinct())
        named = batch if spec.null_safe else batch.dropna(subset=list(spec.keys))
        if not named.groupBy(*spec.keys).count().filter("count > 1").isEmpty():
            raise ValueError("a key has differing rows in one batch: give the column that orders them as seq")
    bucket = F.pmod(F.xxhash64(*spec.keys), F.lit(n)).cast("int")
    touched = sorted(r.b for r in batch.select(bucket.alias("b")).distinct().collect())  # `n` at most
    after, log = apply_changes(_read(spark, table, schema, was["folders"], touched), batch, spec, spec.table, seq, keep)
    folder = f"v={was['version'] + 1}-{uuid.uuid4().hex}"
    after.withColumn("_bucket", bucket).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{table}/{folder}")
    log.write.mode("overwrite").parquet(f"{table}_snapshots/stream={stream}/batch={number}")
    fresh = {str(b): f"{folder}/_bucket={b}" for b in touched}
    replaced = [was["folders"][b] for b in fresh if b in was["folders"]]
    state = {"version": was["version"] + 1, "buckets": n, "folders": was["folders"] | fresh, "replaced": replaced, "streams": was["streams"] | {stream: number}}
    _point(spark, table, state)
    for path in was["replaced"]:
        fs, p = _fs(spark, f"{table}/{path}")
        fs.delete(p, True)
        if not any(x.isDirectory() for x in fs.listStatus(p.getParent())):
            fs.delete(p.getParent(), True)  # all of that version's buckets have been replaced
    return state


def ingest(spark: SparkSession, landing: str, schema, table: str, spec: EntitySpec, checkpoint: str, files_per_trigger: int = 100, seq: str | None = None, buckets: int = 64):
    """Runs over what has landed and stops; the checkpoint keeps the offsets.

    seq: the column that orders a key's rows within a batch; each is logged, the last one stays. Batches
    follow each other as they land. Without it, a key with differing rows in one batch is an error.
    buckets: of a new table; a bucket should fit in a task, so a table of 1 TB wants thousands.
    """

    def merge(batch: DataFrame, number: int) -> None:
        stream = json.loads(_text(spark, f"{checkpoint}/metadata"))["id"]
        held = batch.persist()  # it is read several times
        try:
            merge_batch(spark, table, held, schema, spec, buckets, seq, stream, number)
        finally:
            held.unpersist()

    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
    run = source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return run
