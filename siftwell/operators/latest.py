"""Picks by order: keep latest, first wins, priorities, carried state, ambiguity (E-5, E-7, F-1 to F-8, G-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list, order: list[Column], n: int = 1) -> DataFrame:
    """F-1, F-3, F-6: the first n rows of each key; nulls of a key are one key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def pick(df: DataFrame, keys: list[str], priority: list[Column], columns: list[str]) -> DataFrame:
    """F-7: one row a key, of the greatest priority; partial aggregation, no sort."""
    best = F.max(F.struct(F.struct(*priority).alias("p"), F.struct(*columns).alias("r"))).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_b.r.{c}").alias(c) for c in columns])


def latest_value(value: str, by: str) -> Column:
    """E-5: the value at the greatest `by` where there is one; among equals the smallest value."""
    v, y = F.col(value), F.col(by)
    return F.max(F.when(v.isNotNull(), F.struct(y.alias("y"), (-v).alias("o"), v.alias("v")))).getField("v")


def ordered_list(order: list[Column], payload: Column) -> Column:
    """E-7: payloads in order; the order must be total to be repeatable."""
    items = F.array_sort(F.collect_list(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], payload.alias("p"))))
    return F.transform(items, lambda x: x.p)


def carry_forward(df: DataFrame, keys: list[str], order: list, value: Column, out: str) -> DataFrame:
    """F-5: the last non-null value up to each row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.last(value, True).over(w))


def unless_ambiguous(df: DataFrame, keys: list[str], identity: Column, columns: list[str]) -> DataFrame:
    """F-8: one row a key; its columns are null when the key has several identities."""
    one = F.count_distinct(identity) == 1
    return df.groupBy(*keys).agg(*[F.when(one, F.min(c)).alias(c) for c in columns])


def rank_in_group(df: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:  # F-2
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
