"""Connected components of an edge table, by hooking to the smallest neighbour and pointer jumping; nothing reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.common import drop, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """node, root: the smallest node that each node of an edge reaches. Each round at least halves the roots that have edges."""
    work = materialize(edges.select(F.least(a, b).cast("long").alias("a"), F.greatest(a, b).cast("long").alias("b")).filter("a < b").distinct(), "edges", rows)
    labels, rows = None, 2 * work.count()  # nodes and edges only get fewer
    while not work.isEmpty():
        both = work.unionByName(work.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"), F.lit(True).alias("moved")), "parent", rows)
        while not parent.filter("moved").isEmpty():
            up = parent.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            before, parent = parent, materialize(parent.join(up, parent.root == up._n).select("node", F.col("_r").alias("root"), (F.col("_r") != F.col("root")).alias("moved")), "parent", rows)
            drop(before, shuffles=False)
        if labels is None:
            labels = materialize(parent.drop("moved"), "labels", rows)
        else:
            up = parent.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            before, labels = labels, materialize(labels.join(up, labels.root == up._n, "left").select("node", F.coalesce("_r", "root").alias("root")), "labels", rows)
            drop(before, shuffles=False)
        pa, pb = (parent.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in ("a", "b"))
        before, work = work, materialize(work.join(pa, "a").join(pb, "b").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).filter("a < b").distinct(), "edges", rows)
        drop(before, parent, shuffles=False)
    return labels if labels is not None else work.select(F.col("a").alias("node"), F.col("b").alias("root"))
