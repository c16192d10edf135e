"""Shared plumbing: reading, the shared folder, bounded Arrow batches, gapless ranks, vectorised words.

Words are the runs ``[^\\x20\\x09-\\x0D]+``; they are hashed straight from Arrow's UTF-8 buffers, in steps that
cut inside a text (and inside a word) where it is long, so temporaries stay a few MB whatever a text's size.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step looks at; temporaries are about 60 times that.
STEP_BYTES = 1 << 19
#: A side is broadcast only if its rows, counted first, stay within so many bytes.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_arrow(spark: SparkSession) -> None:
    """Arrow batches of a few MB, so that long texts cannot fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    except Exception:  # noqa: BLE001  an older Spark has no such setting
        return


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where that is unset on one machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    if not found:
        found = getattr(shared_dir, "own", None)
        if not found:
            shared_dir.own = found = "file://" + tempfile.mkdtemp(prefix="siftwell-")
            atexit.register(__import__("shutil").rmtree, found[7:], True)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session is gone; the folder's owner clears it
        return


def materialize(df: DataFrame, tag: str, rows: int | None = None, rows_a_task: int = 100_000) -> DataFrame:
    """Cut lineage through a Parquet table in the shared folder; survives lost executors.

    rows: about how many at most, where that is known; tasks are then as many as they need.
    """
    path = new_path(df.sparkSession, tag)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // rows_a_task)))
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.siftwell_path = path
    return out


def drop(*tables: DataFrame, shuffles: bool = True, session: SparkSession | None = None) -> None:
    """Deletes tables of `materialize` after their last reader; shuffles that nothing refers to any more go as well."""
    for df in tables:
        _remove(session := df.sparkSession, df.siftwell_path)
    if shuffles:
        gc.collect()
        session.sparkContext._jvm.System.gc()  # else shuffle files stay until the driver's heap happens to fill


def small(df: DataFrame, row_bytes: int = 128) -> DataFrame:
    """Marked for broadcast if its rows, counted, fit in BROADCAST_BYTES at `row_bytes` each (in memory)."""
    most = BROADCAST_BYTES // row_bytes
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, holds: tuple | None = None) -> DataFrame:
    """mapInArrow; a task leaves no memory behind in its worker but, for IDLE_S, the cache `holds` (a key of in_worker)."""
    bound_arrow(df.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(holds)
        try:
            yield from fn(rows)
        finally:
            end()

    return df.mapInArrow(run, schema)


#: Seconds after its last task that a worker's cache ends.
IDLE_S = 4
_IN_WORKER: dict = {}
_TIMERS: list[threading.Timer] = []


def in_worker(kind, path: str):
    """The Python worker's own `kind` for a vocabulary; it outlives tasks, so later tasks of the stage find it filled."""
    if (kind.__name__, path) not in _IN_WORKER:
        only((kind.__name__, path))
        _IN_WORKER[kind.__name__, path] = kind(path)
    return _IN_WORKER[kind.__name__, path]


def only(holds: tuple | None) -> None:
    """Caches of other stages end here: workers are reused, and would keep every stage's."""
    gone = [k for k in list(_IN_WORKER) if k != holds]
    for k in gone:
        _IN_WORKER.pop(k, None)
    if gone:
        trim()


def begin(holds: tuple | None) -> None:
    while _TIMERS:
        _TIMERS.pop().cancel()
    only(holds)


def end() -> None:
    """Free memory goes back; what the worker holds follows unless a task comes soon."""
    trim()
    if _IN_WORKER:
        _TIMERS.append(timer := threading.Timer(IDLE_S, only, (None,)))
        timer.daemon = True
        timer.start()


def trim() -> None:
    """Free memory goes back to the machine, which the JVM beside this worker needs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        return


def batch(schema: list[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], names=[n for n, _ in schema])


def lengthened(columns: list[str], name: str) -> list[str]:
    """The columns that are `name` with any number of underscores behind, the longest last; case does not count."""
    return sorted((c for c in columns if c.rstrip("_").lower() == name.rstrip("_").lower() and len(c) >= len(name)), key=len)


def free(columns: list[str], name: str) -> str:
    """`name`, with more underscores behind than any column has that is named so."""
    taken = lengthened(columns, name)
    return name + "_" * (len(taken[-1]) - len(name) + 1) if taken else name


def bucket_rows(rows: int) -> int:
    """Rows that one bucket of a rank should have: a few thousand, or more where the buckets would be over 50,000."""
    return max(2_000, rows // 50_000)


def with_rank(df: DataFrame, group: list[str], order: list[Column], name: str, buckets: int | Column, tag: str | None = None) -> DataFrame:
    """Gapless rank from 0 in each group by `order`; native, and no task holds a whole group.

    The first order key must be a long that is uniform over its whole range (a hash): its top part
    makes `buckets` buckets (a column over the group, or one number), which are ranked apart and shifted by the
    rows of the buckets before. Rows that are alike in the hash share a bucket. df is read twice and has to be the
    same both times; with `tag` it is read once, and written as a table of that name.
    """
    from pyspark.sql import Window as W

    bucket, inside, before = (free([*df.columns, name], x) for x in ("_bucket", "_in", "_before"))
    high = F.shiftright(order[0], 32) + F.lit(1 << 31)
    n = buckets if isinstance(buckets, Column) else F.lit(max(1, buckets))
    df = df.withColumn(bucket, F.shiftright(high * n.cast("long"), 32).cast("int"))
    own = W.partitionBy(*[F.col(c) for c in group], F.col(bucket)).orderBy(*order)
    ranked = df.withColumn(inside, F.row_number().over(own) - 1)
    if tag:
        ranked = df = materialize(ranked, tag)
    earlier = W.partitionBy(*[F.col(c) for c in group]).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    sizes = df.groupBy(*group, bucket).agg(F.count("*").alias(before))
    sizes = sizes.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    return ranked.join(sizes, [*group, bucket]).withColumn(name, (F.col(inside) + F.col(before)).cast("long")).drop(bucket, inside, before)


# ---- vectorised words -------------------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + np.uint64(seed))


WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = keys(256, 11)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]  # A-Z count as a-z
#: What a byte's place in its word multiplies by: the low 12 bits of the place, then the next 12.
_PLACE = keys(4096, 22) | np.uint64(1)
_FAR = keys(4096, 23) | np.uint64(1)
_FAR[0] = 1


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, size: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `size` bytes, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """(a 64-bit hash for each word in order, the first word of each row and their number); `white` cuts words."""
    h, first, _ = word_hashes_at(data, offsets, lower, white)
    return h, first


def word_hashes_at(data: np.ndarray, offsets: np.ndarray, lower: bool = True, white: np.ndarray = WHITE, size: int = STEP_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As word_hashes, and where words start. Bytes are looked at `size` at a time; a word that goes on is summed up."""
    n, sums, starts, opened = len(data), [], [], 0
    for a in range(0, n, size):
        b = min(n, a + size)
        word = ~white[data[a:b]]
        fresh = np.empty(b - a, bool)
        fresh[0] = True
        np.logical_not(word[:-1], out=fresh[1:])
        bounds = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)]
        fresh[bounds - a] = True
        goes_on = opened and word[0] and not (len(bounds) and bounds[0] == a)
        at = np.flatnonzero(fresh & word)
        if not len(at):
            opened = 0
            continue
        place = np.arange(b - a, dtype=np.int64)
        place[at[0] :] -= np.repeat(at, np.diff(at, append=b - a))
        place[: at[0]] = 0
        if goes_on:  # the first word here is the rest of the last one there
            place[: at[1] if len(at) > 1 else b - a] += opened
        place[~word] = 0
        parts = (_LOWER if lower else _BYTE)[data[a:b]] * _PLACE[place & 4095]
        if place.max() > 4095:
            parts *= _FAR[(place >> 12) & 4095]
        parts[~word] = 0
        total = np.add.reduceat(parts, at)
        opened = int(place[-1]) + 1 if word[-1] else 0
        if goes_on:
            sums[-1][-1:] += total[:1]
            total, at = total[1:], at[1:]
        if len(at):
            sums.append(total)
            starts.append(at + a)
    if not sums:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
    starts = np.concatenate(starts)
    return mix(np.concatenate(sums)), np.searchsorted(starts, offsets).astype(np.int64), starts


def shingle_sets(hashes: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """Each row's sorted distinct shingles; with fewer words the whole sequence is one, without words none."""
    k = keys(size, 33) | np.uint64(1)
    whole = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for a in range(0, len(whole), 1 << 18):
        part = whole[a : a + (1 << 18)]
        for i in range(size):
            part += hashes[a + i : a + i + len(part)] * k[i]
        part[:] = mix(part)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            out.append(mix(np.array([np.sum(hashes[a:b] * k[: b - a]) + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
