"""Ordered scans in segments: running values and numbers over an order, with neither a key nor the whole order in one task.

Rows are dealt by ranges of (keys, order), so a key with many rows lies in several neighbouring segments. Each segment is
scanned by itself; what a key's earlier segments leave behind goes to the later ones as at most one row a segment, for only
the first key of a segment began before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.operators.rounds import cut


def _dealt(df: DataFrame, keys: list[str], order: list[Column], segments: int | None) -> tuple[DataFrame, object]:
    """The rows with their segment, and the window of a key's rows in a segment."""
    n = segments or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(max(2, n), *[F.col(k).asc_nulls_first() for k in keys], *order)
    return dealt.withColumn("_segment", F.spark_partition_id()), Window.partitionBy(*keys, "_segment").orderBy(*order)


def _carried(scanned: DataFrame, keys: list[str], tail: Column, carry) -> DataFrame:
    """(keys, _segment, _carry): what earlier segments leave to the first key of a segment; a row a segment at most."""
    tails = scanned.groupBy(*keys, "_segment").agg(tail.alias("_tail"))
    before = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    left = tails.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_segment").alias("_at"), carry(F.col("_tail")).over(before).alias("_carry"))
    return F.broadcast(left.filter("_carry IS NOT NULL"))


def _joined(scanned: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    on = reduce(lambda a, b: a & b, [scanned[k].eqNullSafe(carried[f"_{k}"]) for k in keys], scanned["_segment"] == carried["_at"])
    return scanned.join(carried, on, "left").drop("_at", *[f"_{k}" for k in keys])


def carry_forward(df: DataFrame, keys: list[str], order: list[Column], value: Column, out: str, segments: int | None = None) -> DataFrame:
    """F-5: the last non-null value up to each row of its key. The order has to be total to be repeatable."""
    dealt, own = _dealt(df.withColumn("_value", value), keys, order, segments)
    up_to_here = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = cut(dealt.withColumn("_place", F.row_number().over(own)).withColumn("_last", F.last("_value", True).over(up_to_here)))
    tail = F.max(F.when(F.col("_value").isNotNull(), F.struct(F.col("_place").alias("p"), F.col("_value").alias("v"))))["v"]
    carried = _carried(scanned, keys, tail, lambda t: F.last(t, True))
    return _joined(scanned, carried, keys).withColumn(out, F.coalesce("_last", "_carry")).drop("_value", "_place", "_last", "_carry", "_segment")


def number(df: DataFrame, keys: list[str], order: list[Column], out: str, segments: int | None = None) -> DataFrame:
    """Gapless numbers from 1 by the order, in each key or (without keys) over all rows."""
    dealt, own = _dealt(df, keys, order, segments)
    scanned = cut(dealt.withColumn("_place", F.row_number().over(own)))
    carried = _carried(scanned, keys, F.count("*"), F.sum)
    return _joined(scanned, carried, keys).withColumn(out, F.col("_place") + F.coalesce("_carry", F.lit(0))).drop("_place", "_carry", "_segment")
