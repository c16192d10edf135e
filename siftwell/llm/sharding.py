"""2. Sharding: a uniform shuffle with exact shard sizes, by a hypergeometric communication matrix.

A uniform permutation sends a multivariate hypergeometric number of each partition's rows to each shard.
So the numbers are drawn first: a binary tree over the input partitions splits the shard capacities, each split a
hypergeometric draw by inversion, until every partition (leaf) has its row of the matrix; the tree's top is one row,
below OUTER nodes it goes on in parallel. Then rows are permuted in their partition (a local sort, no exchange), cut
by that row, exchanged once, and permuted again in their shard. All of it is DataFrame and SQL functions. Draws and
places are functions of the seed and of the input's partitions, so a lost task repeats them; what is exchanged are
ids and sizes, never texts.

The law is `rows`: shard counts are at most one apart. Null text: size 1, CRC-32 of nothing. Equal and
repeated rows are told apart by their place in the input and spread like any others; long texts only
count by their bytes. Other columns are ignored, whatever their names. Empty table: no rows. grown_shard is null
under this law.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.llm.common import bucket_rows, drop, materialize, small, table, with_rank

#: Nodes that the tree's single top row is split into, at most.
OUTER = 1024


def _let(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def hypergeometric(t: str, k: str, n: str, u: str) -> str:
    """SQL: the good ones among `n` drawn from `t` of which `k` are good, by inversion at `u`.

    Weights are relative to the window's start, 12 deviations and 30 below the mode.
    """
    ratio = "CAST(p.k - (i - 1) AS DOUBLE) * (p.n - (i - 1)) / (CAST(i AS DOUBLE) * (p.t - p.k - p.n + i))"
    total = f"aggregate(q.ks, named_struct('w', 1D, 's', 1D), (a, i) -> {_let(f'a.w * {ratio}', 'w', "named_struct('w', w, 's', a.s + w)")}, a -> a.s)"
    find = f"aggregate(q.ks, named_struct('w', 1D, 's', 1D, 'at', if(1D >= z, q.a, -1L)), (a, i) -> if(a.at >= 0, a, {_let(f'a.w * {ratio}', 'w', "named_struct('w', w, 's', a.s + w, 'at', if(a.s + w >= z, i, -1L))")}), a -> if(a.at >= 0, a.at, q.b))"
    mode = "least(greatest(CAST(floor((CAST(p.n AS DOUBLE) + 1) * (p.k + 1) / (p.t + 2)) AS BIGINT), p.lo), p.hi)"
    wide = "CAST(30 + ceil(12 * sqrt(CAST(p.n AS DOUBLE) * p.k / greatest(p.t, 1L) * (p.t - p.k) / greatest(p.t, 1L) * (p.t - p.n) / greatest(p.t - 1, 1L))) AS BIGINT)"
    window = f"named_struct('a', greatest(p.lo, {mode} - {wide}), 'b', least(p.hi, {mode} + {wide}))"
    with_ks = "named_struct('a', r.a, 'b', r.b, 'ks', if(r.b > r.a, sequence(r.a + 1, greatest(r.b, r.a + 1)), CAST(array() AS ARRAY<BIGINT>)))"
    draw = _let(window, "r", _let(with_ks, "q", _let(f"{total} * p.u", "z", find)))
    given = f"named_struct('t', {t}, 'k', {k}, 'n', {n}, 'u', {u}, 'lo', greatest(0L, {n} - ({t} - {k})), 'hi', least({n}, {k}))"
    return _let(given, "p", draw)


def halved(tree: DataFrame, size: int, shards: int, seed: int) -> DataFrame:
    """tree's nodes (node, cs: the rows of each of `size` blocks below it, caps: how many go to each shard), split down to blocks."""
    n = "aggregate(cs, 0L, (a, x) -> a + x)"
    uniform = f"CAST(xxhash64({seed}L, node, s) & {2**53 - 1}L AS DOUBLE) / {float(2**53)}D"
    k = hypergeometric("st.t", "element_at(caps, s + 1)", "st.n", uniform)
    then = "named_struct('t', st.t - element_at(caps, s + 1), 'n', st.n - k, 'out', concat(st.out, array(k)))"
    while size > 1:
        half = size // 2
        left = f"aggregate(slice(cs, 1, {half}), 0L, (a, x) -> a + x)"
        draws = f"aggregate(sequence(0, {shards - 1}), named_struct('t', {n}, 'n', {left}, 'out', CAST(array() AS ARRAY<BIGINT>)), (st, s) -> {_let(k, 'k', then)}, st -> st.out)"
        tree = tree.selectExpr("node", "cs", "caps", f"{draws} AS l")
        tree = tree.selectExpr(f"inline(array(named_struct('node', 2 * node, 'cs', slice(cs, 1, {half}), 'caps', l), named_struct('node', 2 * node + 1, 'cs', slice(cs, {half + 1}, {half}), 'caps', zip_with(caps, l, (a, b) -> a - b))))")
        size = half
    return tree


def communication_matrix(counts: DataFrame, blocks: int, shards: int, seed: int) -> DataFrame:
    """From (block, n), blocks below `blocks`: block and edges, the cumulative numbers of its rows that go to shards 0, 1, ..."""
    outer = 1
    while outer < min(blocks, OUTER):
        outer *= 2
    inner = 1
    while outer * inner < blocks:
        inner *= 2

    def dense(size: int) -> str:
        return f"transform(sequence(0, {size - 1}), b -> coalesce(try_element_at(m, CAST(b AS BIGINT)), 0L)) AS cs"

    pairs = F.map_from_entries(F.collect_list(F.struct("b", "n"))).alias("m")
    top = counts.groupBy(F.expr(f"block DIV {inner}").alias("b")).agg(F.sum("n").alias("n")).groupBy().agg(pairs)  # OUTER entries at most
    n = "aggregate(cs, 0L, (a, x) -> a + x)"
    tree = top.selectExpr("1L AS node", dense(outer)).selectExpr("node", "cs", f"transform(sequence(0, {shards - 1}), s -> ({n} + {shards - 1} - s) DIV {shards}) AS caps")
    tree = halved(tree, outer, shards, seed)
    if inner > 1:
        below = counts.selectExpr(f"block DIV {inner} AS up", f"block % {inner} AS b", "n").groupBy("up").agg(pairs)
        tree = tree.join(below, F.col("node") - outer == F.col("up")).selectExpr("node", dense(inner), "caps")
        tree = halved(tree, inner, shards, seed)
    edges = "transform(sequence(1, size(caps)), i -> aggregate(slice(caps, 1, i), 0L, (a, x) -> a + x))"
    return tree.selectExpr(f"node - {outer * inner} AS block", f"{edges} AS edges").filter("element_at(edges, -1) > 0")


def shard(docs: DataFrame, shards: int = 8, seed: int = 1, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: all rows in uniform order over shards of equal counts."""
    text = F.encode(F.coalesce(text_col, F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(F.lit(seed), F.lit("first"), F.monotonically_increasing_id()).alias("first"))
    # The local permutation: after it, the id holds the partition and the place there.
    rows = materialize(rows.sortWithinPartitions("first").select("doc_id", "size", "text_crc32", F.monotonically_increasing_id().alias("row")), "rows")
    placed = rows.withColumn("block", F.shiftright("row", 33)).withColumn("at", F.col("row").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = materialize(placed.groupBy("block").agg(F.count("*").alias("n")), "counts", 1)  # a row for each input partition
    of = counts.agg(F.sum("n").alias("n"), F.max("block").alias("last")).collect()[0]
    if not of.n:
        return placed.selectExpr("doc_id", "size", "text_crc32", "0 AS shard", "0L AS slot")
    matrix = materialize(communication_matrix(counts, of.last + 1, shards, seed), "matrix", of.last + 1)
    drop(counts, shuffles=False)
    cut = placed.join(small(matrix, 128 + 16 * shards), "block").withColumn("shard", F.expr("size(filter(edges, e -> e <= at))"))
    cut = cut.select("doc_id", "size", "text_crc32", "shard", F.xxhash64(F.lit(seed), F.lit("second"), "row").alias("second"), "row")
    return with_rank(cut, ["shard"], [F.col("second"), F.col("row")], "slot", 1 + of.n // (shards * bucket_rows(of.n))).select("doc_id", "size", "text_crc32", "shard", "slot")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
