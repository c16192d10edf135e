"""6. N-gram Jaccard join: exact, by prefixes, block-skipped lists and answers derived from similar sets.

Equal sets become one class. A set can only link if enough of its first shingles (by hash) occur in
another set, which one exchange of those shingles tells; most sets end there. Of those left:

1. Hubs: sets that agree in a min-hash meet the one among them that shares the most; each such pair is
   compared, links join components. This settles groups of near copies by one comparison a member.
2. Set relations: the prefixes' inverted lists hold only what this left open. Lists with one component
   are skipped whole. The others are cut into blocks by size band and position; a set visits the blocks
   whose bounds can still reach the overlap it needs. A pair with one hub in common gets its answer from
   the hub's two answers where they decide it: how many shingles each shares with the hub, and a bitmap
   of those of the hub that it lacks, whose union neither can have in common; only the rest is compared.

So every pair that could link is either joined already, ruled out by a bound, or compared exactly: no
link is lost, and pairs within a component are never expanded. Nulls, empty texts and texts without
words have no shingles and link with nothing; a null id has a null component unless a copy has an id.
Rows count by their texts, so several with one doc_id may be in several components. Texts are read whole, very long
ones in bounded pieces; links are of the whole sets. Ties at the bound link. Other columns are ignored, whatever their
names. Empty table: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import drop, map_arrow, materialize, mix, shingle_sets, small, steps, table, text_buffer, word_hashes
from siftwell.llm.components import components

HASHES = 3
LACKS = ["m0", "m1", "m2", "m3"]
#: A token of so many sets counts as frequent; of these, the FREQUENT most frequent ones are told apart.
HEAVY, FREQUENT = 8, 1 << 17
#: So many pairs with one set are compared beside one copy of it. Lists of more sets are cut into blocks.
MEMBERS, SHORT = 256, 64
_A, _B = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)


def sets_of(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    data, at = text_buffer(column)
    for i, j in steps(at):
        yield from shingle_sets(*word_hashes(data[at[i] : at[j]], at[i : j + 1] - at[i]), size)


def class_key(s: np.ndarray) -> bytes:
    return np.array([mix(s ^ _A).sum(), mix(s ^ _B).sum() + np.uint64(len(s))], np.uint64).tobytes()


def least_overlap(n: int, percent: int) -> int:
    """With how many shingles a set of n must overlap to link with any."""
    return -(-percent * n // 100)


def packed(x: np.ndarray) -> bytes:
    """The low 48 bits of each number, six bytes apiece."""
    return np.ascontiguousarray(x.astype("<u8")[:, None].view(np.uint8)[:, :6]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def differences(x: np.ndarray) -> bytes:
    """Sorted numbers as the bytes of their differences, all lowest bytes first; the high ones are zeros, which compress."""
    return np.ascontiguousarray(np.diff(x, prepend=x.dtype.type(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def summed_up(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def shared_counts(sets: DataFrame, parts: int) -> DataFrame:
    """A table of key and n: for each key how many of its tokens another key has too, in parts to be summed; n is below
    zero for tokens of many keys, whose number it is.

    sets: key long (a hash; its upper 48 bits are the result's), tokens binary (48 bits each, packed). Counts only get
    larger where two fall together. A task sends each token once at most: those that several of its keys have are counted there.
    """
    names = ["kind", "part", "a", "b", "f", "g"]

    def send(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(tok: np.ndarray, key: np.ndarray) -> Iterator[pa.RecordBatch]:
            order = np.lexsort((key, tok))
            tok, key = tok[order], key[order]
            fresh = np.concatenate([[True], (tok[1:] != tok[:-1]) | (key[1:] != key[:-1])])
            tok, key = tok[fresh], key[fresh]
            first = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]]))
            n = np.diff(first, append=len(tok))
            many = np.repeat(n > 1, n)
            one, flags, times = ~many, tok[first[n > 1]], n[n > 1]
            found, hits = np.unique(key[many], return_counts=True)
            to = (mix(found) >> np.uint64(40)) % np.uint64(parts)
            rows = [(1, int(p), packed(found[to == p]), hits[to == p].astype(np.int64).tobytes(), b"", b"") for p in np.unique(to)]
            edges = np.array([-(-(p << 48) // parts) for p in range(1, parts)], np.uint64)
            cut, cut_f = np.searchsorted(tok[one], edges), np.searchsorted(flags, edges)
            for p, (t, k, f, g) in enumerate(zip(np.split(tok[one], cut), np.split(key[one], cut), np.split(flags, cut_f), np.split(times, cut_f))):
                if len(t) or len(f):
                    rows.append((0, p, differences(t), packed(k), differences(f), g.astype(np.int64).tobytes()))
            for r in rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0]], pa.int32()), pa.array([r[1]], pa.int32()), *(pa.array([x], pa.binary()) for x in r[2:])], names=names)

        tok, key, size = [], [], 0
        for b in rows:
            for k, t in zip(b.column(0).to_numpy().view(np.uint64) >> np.uint64(16), b.column(1)):
                t = unpacked(t.as_buffer())
                tok.append(t)
                key.append(np.full(len(t), k, np.uint64))
                size += len(t)
                if size >= 1 << 20:
                    yield from out(np.concatenate(tok), np.concatenate(key))
                    tok, key, size = [], [], 0
        if size:
            yield from out(np.concatenate(tok), np.concatenate(key))

    def meet(group, t):
        """Keys with their hits, and tokens of many keys with these' number below zero."""
        if group[0].as_py() == 1:
            key, hits = (np.concatenate([f(x.as_py()) for x in t.column(c)]) for c, f in (("a", unpacked), ("b", lambda x: np.frombuffer(x, np.int64))))
            found, at = np.unique(key, return_inverse=True)
            return pa.table({"key": found.view(np.int64), "n": np.bincount(at, hits, len(found)).astype(np.int64)})
        a, b, f, g = (np.concatenate([decode(x.as_py()) for x in t.column(c)]) for c, decode in (("a", summed_up), ("b", unpacked), ("f", summed_up), ("g", lambda x: np.frombuffer(x, np.int64))))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
        a, b = a[fresh], b[fresh]
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
        n = np.diff(first, append=len(a))
        found, times = np.unique(b[np.repeat((n > 1) | np.isin(a[first], f), n)], return_counts=True)
        every, at = np.unique(np.concatenate([a[first], f]), return_inverse=True)
        sizes = np.bincount(at, np.concatenate([n, g]), len(every)).astype(np.int64)
        heavy = sizes >= HEAVY
        return pa.table({"key": np.concatenate([found, every[heavy]]).view(np.int64), "n": np.concatenate([times.astype(np.int64), -sizes[heavy]])})

    sent = map_arrow(sets, send, "kind int, part int, a binary, b binary, f binary, g binary")
    return materialize(sent.groupBy("kind", "part").applyInArrow(meet, "key long, n long"), "hits")


def with_shared(df: DataFrame, key: Column, hits: DataFrame) -> DataFrame:
    """The rows of df whose key shares tokens, and `shared`, how many."""
    found = hits.filter("n > 0").groupBy("key").agg(F.sum("n").alias("shared"))
    return df.withColumn("key", F.shiftrightunsigned(key, 16)).join(small(found, 96), "key").drop("key")


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """x, y, nx, ny, common (the exact overlap of each pair's sets), m0 to m3 (a bitmap of y's shingles that x lacks).

    A set that many others are compared with is sent once for every MEMBERS of them, so they spread over tasks.
    """
    one = sets.select(F.col("id").alias("x"), F.col("n").alias("nx"), F.col("tokens").alias("tx"))
    copies = pairs.groupBy("y").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("_of"))
    copies = small(copies, 96)
    two = sets.select(F.col("id").alias("y"), F.col("n").alias("ny"), F.col("tokens").alias("ty")).join(copies, "y").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_of") - 1))).drop("_of")
    salted = pairs.join(copies, "y").withColumn("_salt", F.pmod(F.xxhash64("x"), F.col("_of")).cast("int")).drop("_of")

    def overlap(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            n, lacks = [], np.zeros((b.num_rows, 256), np.uint8)
            for row, s, t in zip(lacks, b.column(4), b.column(5)):
                s, t = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                there = np.zeros(len(t), bool) if not len(s) else s[np.minimum(np.searchsorted(s, t), len(s) - 1)] == t
                n.append(int(there.sum()))
                row[(t[~there] & np.uint64(255)).astype(np.int64)] = 1
            bits = np.packbits(lacks, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(n, pa.int64()), *(pa.array(bits[:, k]) for k in range(4))], names=["x", "y", "nx", "ny", "common", *LACKS])

    both = salted.join(one, "x").join(two, ["y", "_salt"]).select("x", "y", "nx", "ny", "tx", "ty")
    return map_arrow(both, overlap, "x long, y long, nx long, ny long, common long, m0 long, m1 long, m2 long, m3 long")


def link(docs: DataFrame, size: int = 5, percent: int = 80, text_col: str = "text", id_col: str = "doc_id", part_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, n_shingles, component_id and text_hash (xxhash64 of the text) of every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def describe(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in rows:
            n, key, prefix = [], [], []
            for s in sets_of(b.column(1), size):
                k = class_key(s)
                n.append(len(s))
                key.append(k)
                prefix.append(None if k in seen or not len(s) else packed(s[: least_prefix(len(s))] >> np.uint64(16)))  # once a task
                if len(seen) < 1 << 17:
                    seen.add(k)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(prefix, pa.binary())], names=["doc_id", "text_hash", "n", "c", "prefix"])

    def least_prefix(n: int) -> int:
        return n - least_overlap(n, percent) + 1 + n // 10

    described = materialize(map_arrow(docs.withColumn("text_hash", F.xxhash64("text")), describe, "doc_id long, text_hash long, n long, c binary, prefix binary"), "described")
    rows = materialize(described.drop("prefix"), "rows")
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).collect()[0].n or 0
    parts = max(48, math.ceil(total / part_bytes))
    classes = materialize(rows.filter("n > 0").groupBy("c").agg(F.min("doc_id").alias("id"), F.min("n").alias("n")), "classes")
    # Both sets of a pair have the pair's first 1 + n // 10 common shingles in these prefixes, n of the smaller set.
    hits = shared_counts(described.filter("prefix is not null").select(F.xxhash64("c").alias("key"), F.col("prefix").alias("tokens")), parts)
    alive = with_shared(classes.filter("id is not null"), F.xxhash64("c"), hits).filter(F.col("shared") >= F.greatest(F.lit(1), F.expr(f"(n * {percent} DIV 100) DIV 10")))
    alive = materialize(alive.select("id", "c", F.xxhash64("c").alias("node"), F.xxhash64("id", "c").alias("own")), "alive")
    drop(described, hits)

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            found = list(sets_of(b.column(1), size))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([class_key(s) for s in found], pa.binary()), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["id", "c", "n", "tokens"])

    wanted = small(alive.select(F.col("id").alias("doc_id")).distinct(), 96)
    sets = map_arrow(docs.join(wanted, "doc_id", "left_semi"), read, "id long, c binary, n long, tokens binary")
    sets = sets.withColumn("own", F.xxhash64("id", "c")).join(small(alive.select("own"), 96), "own", "left_semi")
    twice = rows.join(small(alive.select(F.col("id").alias("doc_id"), "c")), ["doc_id", "c"], "left_semi").groupBy("doc_id", "c").count().filter("count > 1")
    if not twice.isEmpty():  # repeated rows: one of them stands for the class
        sets = sets.dropDuplicates(["own"])
    first = materialize(sets.select(F.xxhash64("c").alias("id"), "n", "tokens"), "sets")
    hits = shared_counts(map_arrow(first.select(F.xxhash64("id").alias("key"), "tokens"), shortened, "key long, tokens binary"), parts)
    sets = materialize(with_shared(first, F.xxhash64("id"), hits).filter(100 * F.col("shared") >= percent * F.col("n")), "sets")
    heavy = hits.filter("n < 0").groupBy(F.col("key").alias("token")).agg(F.min("n").alias("n"))
    frequent = heavy.orderBy("n", "token").limit(FREQUENT).collect()  # of a bounded table
    drop(first, hits)
    labels = linked(sets, percent, np.array(sorted((r.token, -r.n) for r in frequent), np.int64).reshape(-1, 2))
    drop(sets)

    member = classes.withColumn("node", F.xxhash64("c")).join(small(labels, 96), "node")
    least = member.groupBy("root").agg(F.min("id").alias("component"))
    linked_to = small(member.join(least, "root").select("c", "component"))
    every = materialize(classes.join(linked_to, "c", "left").select("c", F.coalesce("component", "id").alias("component")), "members")
    # Rows without shingles share one class and need none; of any other class there is one row in `every`, so copies can be split.
    out = rows.filter("n > 0").join(small(every), "c", "left").unionByName(rows.filter("n = 0").withColumn("component", F.lit(None).cast("long")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), "text_hash")


def shortened(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The upper 48 bits of the tokens, packed."""
    for b in rows:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([packed(np.frombuffer(t.as_buffer(), np.uint64) >> np.uint64(16)) for t in b.column(1)], pa.binary())], names=["key", "tokens"])


def linked(sets: DataFrame, percent: int, frequent: np.ndarray) -> DataFrame:
    """node, root over the ids that link. sets: id (of a class), n, shared, tokens (sorted). frequent: (48-bit token, its sets), sorted."""
    p = percent
    links = F.expr(f"{100 + p} * common >= {p} * (nx + ny)")

    def hashes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix(np.arange(1, HASHES + 1, dtype=np.uint64))
        for b in rows:
            m = np.array([[mix(np.frombuffer(t.as_buffer(), np.uint64) ^ s).min() for s in seeds] for t in b.column(2)], np.uint64).reshape(b.num_rows, HASHES)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at := pa.array(np.repeat(np.arange(b.num_rows), HASHES))), b.column(1).take(at), pa.array(np.tile(np.arange(HASHES, dtype=np.int32), b.num_rows)), pa.array(m.ravel().view(np.int64))], names=["id", "rare", "j", "h"])

    hashed = map_arrow(sets.select("id", F.expr("1 - shared / n").alias("rare"), "tokens"), hashes, "id long, rare double, j int, h long")
    n = HASHES * sets.count()
    hashed = materialize(hashed, "hashed", n, 5_000)
    hubs = hashed.groupBy("j", "h").agg(F.min(F.struct("rare", "id")).alias("best"), F.count("*").alias("k")).filter("k > 1").select("j", "h", F.col("best.id").alias("y"))
    pairs = hashed.select(F.col("id").alias("x"), "j", "h").join(hubs, ["j", "h"]).filter("x <> y").select("x", "y").distinct()
    pairs = materialize(pairs, "pairs", n)
    compared = materialize(compare(pairs, sets), "compared", n, 5_000)
    drop(hashed, pairs, shuffles=False)
    first = compared.filter(links).select("x", "y")
    labels = components(first, "x", "y", n)
    # Each set with its component and the most met of its hubs, so that sets of one group have one in common.
    met_by = compared.groupBy("y").agg(F.count("*").alias("k"))
    best = compared.join(small(met_by), "y").groupBy("x").agg(F.max(F.struct("k", F.col("y").alias("hub"), "common", F.col("ny").alias("nh"), *LACKS)).alias("best"))
    known = sets.join(small(labels.withColumnRenamed("node", "id"), 96), "id", "left").join(small(best.withColumnRenamed("x", "id"), 256), "id", "left")
    known = known.select("id", "n", "shared", "tokens", F.coalesce("root", "id").alias("label"), F.col("best.hub").alias("hub"), F.col("best.common").alias("o"), F.col("best.nh").alias("nh"), *[F.col(f"best.{m}").alias(m) for m in LACKS])

    often = sets.sparkSession.sparkContext.broadcast(frequent)

    def rare_first(tokens: np.ndarray) -> np.ndarray:
        """In the order of all sets: the frequent ones last, by how frequent they are; else by hash."""
        tokens = np.frombuffer(tokens, np.uint64)
        found, times = often.value.T
        if not len(found):
            return tokens
        short = (tokens >> np.uint64(16)).astype(np.int64)
        at = np.minimum(np.searchsorted(found, short), len(found) - 1)
        return tokens[np.lexsort((tokens, np.where(found[at] == short, times[at], 0)))]

    def post(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            n, tokens = b.column(1).to_numpy(), b.column(3)
            short = [int(m) - least_overlap(int(m), p) + 1 for m in n]
            at = pa.array(np.repeat(np.arange(len(n)), short))
            token = np.concatenate([rare_first(t.as_buffer())[:k].view(np.int64) for t, k in zip(tokens, short)]) if len(n) else np.zeros(0, np.int64)
            place = np.concatenate([np.arange(k) for k in short]) if len(n) else np.zeros(0, np.int64)
            keep = [0, 1, 2, *range(4, 12)]
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in keep), pa.array(token), pa.array(place, pa.int64())], names=[*(b.schema.names[k] for k in keep), "token", "place"])

    lists = map_arrow(known, post, "id long, n long, shared long, label long, hub long, o long, nh long, m0 long, m1 long, m2 long, m3 long, token long, place long")
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / p)).cast("int")
    lists = materialize(lists.withColumn("band", band).withColumn("block", F.expr("place * 40 DIV n").cast("int")), "lists")
    drop(compared)
    # Lists with one component are skipped; in the others, what isn't of the largest component meets the rest.
    sizes = lists.groupBy("token", "label").agg(F.count("*").alias("k"))
    open_ = sizes.groupBy("token").agg(F.max(F.struct("k", "label")).alias("most"), F.count("*").alias("labels"), F.sum("k").alias("k")).filter("labels > 1").select("token", F.col("most.label").alias("largest"), (F.col("k") > SHORT).alias("long"))
    open_ = materialize(open_, "open", lists.count())
    # A short list is one block.
    rest = lists.join(small(open_, 96), "token").withColumns({c: F.when(F.col("long"), F.col(c)).otherwise(0) for c in ("band", "block")})
    x = rest.filter("label <> largest")
    x = x.withColumn("band", F.explode(F.when(F.col("long"), F.array(*[F.col("band") + d for d in (-1, 0, 1)])).otherwise(F.array(F.lit(0)))))
    # In a band sizes stay below (100 / p) ^ (band + 1): with a set of n there, the place is at most this share of its own.
    top = F.expr(f"pow({100 / p}D, band + 1) * 1.000001")
    reach = 1 - p / (100 + p) * (F.col("n") / top + 1)
    x = x.withColumn("block", F.explode(F.when(F.col("long"), F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(40 * reach).cast("int")))).otherwise(F.array(F.lit(0)))))
    x = x.select("token", "band", "block", *[F.col(c).alias(f"{c}_") for c in ("id", "n", "shared", "label", "hub", "o", "nh", "place", *LACKS)])
    y = rest.drop("largest", "long")
    need = F.ceil(F.expr(f"({p} * (n + n_)) / {100 + p}D"))
    one_hub = F.col("hub") == F.col("hub_")
    lacking = sum(F.bit_count(F.col(m).bitwiseOR(F.col(f"{m}_"))) for m in LACKS)
    reachable = [
        F.col("label") != F.col("label_"),
        F.least(F.col("n") - F.col("place"), F.col("n_") - F.col("place_")) >= need,
        F.least("shared", "shared_") >= need,
        ~F.coalesce(one_hub & (F.col("nh") - lacking + F.least(F.col("shared") - F.col("o"), F.col("shared_") - F.col("o_")) < need), F.lit(False)),
    ]
    met = x.join(y, ["token", "band", "block"])
    for condition in reachable:
        met = met.filter(condition)
    sure = F.coalesce(one_hub & (F.col("o") + F.col("o_") - F.col("nh") >= need), F.lit(False))
    met = met.groupBy(F.least("id", "id_").alias("x"), F.greatest("id", "id_").alias("y")).agg(F.bool_or(sure).alias("sure"))
    met = materialize(met, "met")
    drop(lists, open_)
    second = compare(met.filter("not sure").select("x", "y"), sets).filter(links).select("x", "y").unionByName(met.filter("sure").select("x", "y"))
    a, b = (labels.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in ("x", "y"))
    bridges = second.join(a, "x", "left").join(b, "y", "left").select(F.coalesce("rx", "x").alias("x"), F.coalesce("ry", "y").alias("y"))
    over = components(bridges, "x", "y", met.count()).select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    own = labels.join(over, labels.root == over._n, "left").select("node", F.coalesce("_r", "root").alias("root"))
    return own.unionByName(over.select(F.col("_n").alias("node"), F.col("_r").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents")).drop("text_hash")
