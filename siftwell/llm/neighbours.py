"""7. Approximate nearest neighbours: a permutation index.

Pivots are a bounded sample of the vectors, PIVOTS at any size. Each vector is represented by the order of its
pivots from the nearest on, a byte a pivot, and posted in the inverted files of the first `posted` of them; long files
are cut into blocks by a hash of vec_id, so a common vector or pivot cannot fill a task. A query visits the files of
its first `visited` pivots; there, entries are ranked by Spearman's footrule between the pivot orders, and the nearest
`share` of them (`least` at least) are reranked by exact Euclidean distance in double precision. An entry counts in
the first visited file that holds it. Files hold the vectors too: to fetch those reranked would move one for each
query that asks, which are more than `posted`. Queries that found fewer neighbours than there are visit all files.

Vectors that are null, zero, hold null or non-finite components, or have another length than most take
no part. Equal vectors are all indexed; ties go to the smaller vec_id. Null vec_ids take no part. Repeated rows count
once; several vectors with one vec_id: each is indexed, queries never return their own vec_id. Other columns are
ignored, whatever their names. Empty table: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.llm.common import map_arrow, materialize, table

RESULT = "query_id long, vec_id long, score double"
PIVOTS = 256


def usable(vectors: DataFrame, vector_col: str, id_col: str) -> DataFrame:
    """vec_id and v of the rows that take part, each once."""
    v = F.col("v")
    ok = F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    out = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).filter(ok)
    most = out.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return materialize(out.filter(F.size("v") == (most[0].n if most else 0)).distinct(), "vectors").withColumn("v", v.cast("array<double>"))


def choose_pivots(vectors: DataFrame, total: int, n: int, seed: int) -> np.ndarray:
    """`n` distinct vectors (all, if fewer), the first by hash among about 16 n rows, or all where that leaves too few."""
    at = F.xxhash64(F.lit(seed), "v")
    for some in (vectors.filter(F.pmod(at, F.lit(1_000_000)) < 16e6 * n / total), vectors):
        found = some.select("v").distinct().orderBy(at, "v").limit(n).collect()
        if len(found) == n:
            break
    return np.array([r.v for r in found], float).reshape(len(found), -1)


def search(vectors: DataFrame, is_query: Column, top: int = 10, pivots: int = PIVOTS, posted: int = 4, visited: int = 48, share: float = 0.06, least: int = 24, block: int = 8_000, queries: int = 50_000, seed: int = 1, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id, score: each query's `top` nearest of the others; is_query is over vec_id."""
    spark = vectors.sparkSession
    data = usable(vectors, vector_col, id_col)
    kind = "<f4" if "float" in vectors.schema[vector_col].dataType.simpleString() else "<f8"  # as given: floats lose nothing
    total = data.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = choose_pivots(data, total, min(256, pivots), seed)
    p = len(points)
    posted, visited = min(p, posted), min(p, visited)
    own = spark.sparkContext.broadcast(points)

    def represent(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pts = own.value
        for b in rows:
            for a in range(0, b.num_rows, 1024):
                part = b.slice(a, 1024)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                order = ((pts**2).sum(1) - 2 * x @ pts.T).argsort(1, kind="stable")
                ranks = np.empty(order.shape, np.uint8)
                np.put_along_axis(ranks, order, np.arange(p, dtype=np.uint8)[None].repeat(len(order), 0), 1)
                cells = [pa.array([r.tobytes() for r in y], pa.binary()) for y in (x.astype(kind), ranks)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cells, pa.array(list(order.astype(np.int32)), pa.list_(pa.int32())), part.column(2)], names=["vec_id", "x", "ranks", "order", "q"])

    made = map_arrow(data.select("vec_id", "v", is_query.alias("q")), represent, "vec_id long, x binary, ranks binary, `order` array<int>, q boolean")
    posts = materialize(made.withColumn("order", F.when(F.col("q"), F.col("order")).otherwise(F.slice("order", 1, posted))), "posts")
    at = F.xxhash64(F.lit(seed), "vec_id", "x")

    def found_by(asked: DataFrame, visited: int) -> DataFrame:
        """What the queries of `asked` find in the files of their first `visited` pivots."""
        sizes = posts.select(F.explode(F.slice("order", 1, posted)).alias("pivot")).groupBy("pivot").agg(F.count("*").alias("n"))
        visits = asked.select(F.explode(F.slice("order", 1, visited)).alias("pivot")).groupBy("pivot").agg(F.count("*").alias("nq"))
        sizes = sizes.join(visits, "pivot").select("pivot", F.ceil(F.col("n") / block).cast("int").alias("eb"), F.ceil(F.col("nq") / queries).cast("int").alias("qb"))
        sizes = F.broadcast(sizes)  # 256 rows at most
        entries = posts.select("vec_id", "x", "ranks", at.alias("h"), F.explode(F.slice("order", 1, posted)).alias("pivot")).join(sizes, "pivot")
        entries = entries.withColumn("e", F.pmod("h", F.col("eb")).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("qb") - 1))).select("pivot", "e", "b", "vec_id", "x", "ranks")
        sent = asked.select("vec_id", "x", "ranks", at.alias("h"), F.explode(F.slice("order", 1, visited)).alias("pivot")).join(sizes, "pivot")
        sent = sent.withColumn("b", F.pmod("h", F.col("qb")).cast("int")).withColumn("e", F.explode(F.sequence(F.lit(0), F.col("eb") - 1))).selectExpr("pivot AS qp", "e AS qe", "b AS qb", "vec_id AS qid", "x AS qx", "ranks AS qranks")

        def visit(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            pivot, out = int(key[0]), []
            if not len(left) or not len(right):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            left = left.sort_values("vec_id", kind="stable")
            ids, x = left.vec_id.to_numpy(), np.frombuffer(b"".join(left.x), kind).reshape(len(left), -1).astype(float)
            place = np.frombuffer(b"".join(left.ranks), np.uint8).reshape(len(left), -1)
            files = place < posted
            place = place.astype(np.int16)
            for r in right.itertuples(index=False):
                mine, q = np.frombuffer(r.qranks, np.uint8).astype(np.int16), np.frombuffer(r.qx, kind).astype(float)
                here = np.flatnonzero(~files[:, mine < mine[pivot]].any(1) & (ids != r.qid))
                if not len(here):
                    continue
                foot = np.abs(place[here] - mine).sum(1, dtype=np.int32)
                n = min(len(here), max(least, top, math.ceil(share * len(here))))
                best = here[np.argsort(foot, kind="stable")[:n]]
                dist = np.sqrt(((x[best] - q) ** 2).sum(1))
                best = best[(o := np.lexsort((ids[best], dist))[:top])]
                out.append(pd.DataFrame({"query_id": r.qid, "vec_id": ids[best], "score": dist[o]}))
            return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

        return materialize(entries.groupBy("pivot", "e", "b").cogroup(sent.groupBy("qp", "qe", "qb")).applyInPandas(visit, RESULT), "found")

    asked = posts.filter("q")
    found = found_by(asked, visited)
    short = asked.join(found.select(F.col("query_id").alias("vec_id"), F.col("vec_id").alias("other")).distinct().groupBy("vec_id").count(), "vec_id", "left").filter(F.coalesce("count", F.lit(0)) < min(top, total - 1)).drop("count")
    if visited < p and not short.isEmpty():
        found = found.unionByName(found_by(materialize(short, "short"), p))
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
