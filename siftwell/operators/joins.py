"""Join operators, generic over column names (D-4, D-7, D-9 to D-18)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siftwell.operators.name_index import Texts, index_of
from siftwell.operators.rounds import cut
from siftwell.operators.scan import carry_forward

#: A side is broadcast only up to this many rows, counted first; names for indexes only up to so many bytes, for one of them up to
#: so many (a worker holds one at a time, of about 7 times its bytes); texts that take turns at several indexes, up to so many.
BROADCAST_ROWS, NAME_BYTES, INDEX_BYTES, SLAB_BYTES = 200_000, 128 << 20, 32 << 20, 64 << 20


def checked_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], safe: list[str] | None = None) -> Column:
    """C-3: equality on keys, null-safe for those in `safe` (all, unless given); still a hash join."""
    safe = keys if safe is None else safe
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) if k in safe else left[k] == right[k] for k in keys])


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:  # D-4
    r = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"_{k}"]) for k in keys])
    return left.join(r, on, how).drop(*[f"_{k}" for k in keys])


def asof_floor(probes: DataFrame, points: DataFrame, keys: list[str], by: str, value: str, out: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """D-7: for each probe the value at the greatest point <= its `by`, within null-safe keys. No range join.

    Up to `most` points, counted first, travel as one sorted list a key, so a key with many probes makes no large task;
    beyond, probes and points are scanned together in segments, of which a key may have many.
    """
    known = points.filter(F.col(by).isNotNull() & F.col(value).isNotNull())
    if known.limit(most + 1).count() <= most:
        lists = known.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.sort_array(F.collect_list(F.struct(F.col(by).alias("b"), F.col(value).alias("v")))).alias("_points"))
        on = reduce(lambda a, b: a & b, [probes[k].eqNullSafe(lists[f"_{k}"]) for k in keys])
        joined = probes.join(F.broadcast(lists), on, "left")
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])  # a binary search: how many points are not above
        reached = lambda n, step: F.try_element_at(F.col("_points"), n + step).b <= F.col(by)
        found = F.aggregate(steps, F.lit(0), lambda n, step: F.when(reached(n, step), n + step).otherwise(n))
        return joined.withColumn(out, F.when(found > 0, F.try_element_at(F.col("_points"), found).v)).drop("_points", *[f"_{k}" for k in keys])
    cols = [c for c in probes.columns if c not in (*keys, by)]
    left = probes.select(*keys, by, F.lit(1).alias("_side"), F.lit(None).cast(points.schema[value].dataType).alias("_v"), F.struct(*[F.col(c) for c in cols]).alias("_row") if cols else F.lit(None).alias("_row"))
    right = known.select(*keys, by, F.lit(0).alias("_side"), F.col(value).alias("_v"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"))
    seen = carry_forward(right.unionByName(left), keys, [F.col(by).asc_nulls_first(), F.col("_side").asc(), F.col("_v").asc()], F.col("_v"), out).filter("_side = 1")
    return seen.select(*keys, by, *[F.col(f"_row.{c}").alias(c) for c in cols], out)


def unique_lookup(dim: DataFrame, key: str | Column, ident: str, out: str = "resolved") -> DataFrame:
    """D-11: key and the id, for keys with exactly one distinct id."""
    k = F.col(key) if isinstance(key, str) else key
    return dim.filter(k.isNotNull()).groupBy(k.alias("_key")).agg(F.count_distinct(ident).alias("_n"), F.min(ident).alias(out)).filter("_n = 1").drop("_n")


def resolve_unique(facts: DataFrame, dim: DataFrame, fact_key: Column, dim_key: str | Column, ident: str, out: str) -> DataFrame:  # D-11
    look = unique_lookup(dim, dim_key, ident, out)
    return facts.join(look, fact_key == look["_key"], "left").drop("_key")


def resolve_cascade(facts: DataFrame, tiers: list[tuple[str, Column, DataFrame]], out: str) -> DataFrame:
    """D-12: the first tier that resolves wins; tiers are (name, key of the fact, _key -> id table with one row a key)."""
    for i, (_, key, look) in enumerate(tiers):
        t = look.toDF(f"_k{i}", f"_id{i}")
        facts = facts.join(t, key == t[f"_k{i}"], "left").drop(f"_k{i}")
    ids = [F.col(f"_id{i}") for i in range(len(tiers))]
    by = reduce(lambda acc, i: acc.when(ids[i].isNotNull(), tiers[i][0]), range(len(tiers)), F.when(F.lit(False), F.lit(None).cast("string")))
    return facts.withColumn(out, F.coalesce(*ids)).withColumn(f"{out}_by", by).drop(*[f"_id{i}" for i in range(len(tiers))])


def prefix_lookup(dim: DataFrame, code: str, ident: str, size: int, out: str = "resolved") -> DataFrame:  # D-13
    return unique_lookup(dim.filter(F.length(code) >= size), F.left(F.col(code), F.lit(size)), ident, out)


def name_groups(names: list[str], most: int) -> list[str]:
    """The names joined by NUL, in groups of `most` bytes; a longer name is a group of its own."""
    groups, size = [[]], 0
    for name in names:
        n = len(name.encode()) + 1
        if size + n > most and groups[-1]:
            groups.append([])
            size = 0
        groups[-1].append(name)
        size += n
    return ["\0".join(g) for g in groups]


def slabs(batches: Iterator[pa.RecordBatch], at: int, most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in a row until their column `at` has `most` bytes."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(at).nbytes
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def contained(texts: DataFrame, text: str, names: DataFrame, name: str, out: str, which: str = "longest", most: int = NAME_BYTES, group: int = INDEX_BYTES, keep: list[str] | None = None) -> DataFrame:
    """D-16: each row with the name that its text contains: the `longest` (ties to the smaller), or the `first` to begin (ties to
    the longer). Null if none; rows stand for themselves, whatever they repeat. Empty names and names with a NUL count for nothing.
    keep: the columns that go with it, all unless given.

    Up to `most` bytes of names, summed first, become indexes of `group` bytes of names, the longest names first. A worker holds one at a
    time: a single one reads the texts as they come, several take turns at slabs of them, each at the texts that may
    still find a better name. Beyond, texts are cut into pieces of the names' lengths that meet the names in a join.
    """
    keep = texts.columns if keep is None else keep
    held = cut(names.select(F.col(name).alias("_name")).filter("length(_name) > 0 AND NOT contains(_name, '\\0')").distinct())
    size = held.agg(F.count("*").alias("n"), F.sum(F.octet_length("_name") + 1).alias("bytes")).head()
    if not size.n:
        return texts.select(*keep, F.lit(None).cast("string").alias(out))
    if size.bytes > most:
        return _contained_by_join(texts, text, held, out, which).select(*keep, out)
    ranked = sorted(held.toArrow()["_name"].to_pylist())  # `most` bytes at most
    ranked.sort(key=len, reverse=True)
    groups = [g.encode() for g in name_groups(ranked, group)]
    shared, token, longest = texts.sparkSession.sparkContext.broadcast(groups), hash(tuple(groups)), which == "longest"
    slab = SLAB_BYTES if len(groups) > 1 else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in slabs(batches, 0, slab):
            asked, before = [Texts(b.column(0), longest) for b in held], 0
            for k, names in enumerate(shared.value):
                index = index_of((token, k), names)
                for x in asked:
                    x.look_up(index, before)
                before += index.start.size
            for b, x in zip(held, asked):
                yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(x.found, pa.string())], names=[*keep, out])

    return texts.select(F.col(text).alias("_text"), *keep).mapInArrow(run, StructType([*[texts.schema[c] for c in keep], StructField(out, StringType())]))


def _contained_by_join(texts: DataFrame, text: str, held: DataFrame, out: str, which: str) -> DataFrame:
    lengths = sorted(r.n for r in held.select(F.length("_name").alias("n")).distinct().collect())
    rows, size = cut(texts.withColumn("_row", F.monotonically_increasing_id())), F.length(F.col(text))

    def of_length(n: int) -> Column:
        return F.when(size >= n, F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.struct(i.alias("at"), F.substring(F.col(text), i, F.lit(n)).alias("name"))))

    cut_up = rows.select("_row", F.explode(F.flatten(F.array_compact(F.array(*map(of_length, lengths))))).alias("_p")).select("_row", "_p.at", F.col("_p.name").alias("_name"))
    smaller = F.transform(F.split("_name", ""), lambda c: -F.ascii(c))
    order = [F.length("_name").alias("n"), smaller.alias("k")] if which == "longest" else [(-F.col("at")).alias("a"), F.length("_name").alias("n")]
    hits = cut_up.join(held, "_name").groupBy("_row").agg(F.max(F.struct(*order, "_name"))["_name"].alias(out))
    return rows.join(hits, "_row", "left").drop("_row")


def contained_either_way(texts: DataFrame, text: str, names: DataFrame, name: str, out: str) -> DataFrame:
    """D-16, both ways: the longest name within the text, else the shortest name that the whole text lies within."""
    inner = contained(texts, text, names, name, out)
    open_texts = inner.filter(F.col(out).isNull() & (F.length(text) > 0)).select(F.col(text).alias("_t")).distinct()
    outer = contained_in(names.select(F.col(name).alias("_name")).distinct(), "_name", open_texts, "_t")
    best = outer.groupBy("_t").agg(F.min(F.struct(F.length("_name").alias("n"), "_name"))["_name"].alias("_around"))
    return inner.join(best, inner[text] == best["_t"], "left").withColumn(out, F.coalesce(out, "_around")).drop("_t", "_around")


def contained_in(longer: DataFrame, text: str, shorter: DataFrame, part: str) -> DataFrame:
    """The pairs (text, part) where a short string lies within a longer one; pieces of the parts' lengths meet them in a join."""
    lengths = sorted(r.n for r in shorter.select(F.length(part).alias("n")).distinct().collect())
    size = F.length(F.col(text))
    pieces = [F.when(size >= n, F.transform(F.sequence(F.lit(1), size - n + 1), lambda i, n=n: F.substring(F.col(text), i, F.lit(n)))) for n in lengths]
    if not pieces:
        return longer.select(text).limit(0).withColumn(part, F.lit(""))
    return longer.select(text, F.explode(F.array_distinct(F.flatten(F.array_compact(F.array(*pieces))))).alias(part)).join(shorter.select(part).distinct(), part)


def longest_contained(texts: DataFrame, text: str, ident: list[str], names: DataFrame, name: str, out: str) -> DataFrame:
    """D-16 with `ident`, which rows no longer need."""
    return contained(texts, text, names, name, out)


def prefer_source(preferred: DataFrame, other: DataFrame, keys: list[str], safe: list[str] | None = None) -> DataFrame:
    """D-18: rows of `other` without a preferred row of the same key."""
    seen = preferred.select(*keys).distinct()
    return other.join(seen, null_safe(other, seen, keys, safe or []), "left_anti")


def exists_flag(left: DataFrame, right: DataFrame, keys: list[str], out: str) -> DataFrame:  # D-9
    return left.join(right.select(*keys).distinct().withColumn(out, F.lit(True)), keys, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def orphans(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:  # D-15
    d = dim.select(F.col(dim_key).alias("_k")).distinct()
    return facts.filter(F.col(fact_key).isNotNull()).join(d, F.col(fact_key) == F.col("_k"), "left_anti")


def split_or_join(facts: DataFrame, rows: DataFrame, ident: str, name: str, scope: list[str]) -> DataFrame:
    """D-14: by id, and by name those without an id that have no identified sibling of the same scope and name."""
    by_id = facts.join(rows.filter(F.col(ident).isNotNull()).drop(name), [*scope, ident])
    known = rows.filter(F.col(ident).isNotNull()).select(*scope, name).distinct()
    loose = rows.filter(F.col(ident).isNull()).join(known, [*scope, name], "left_anti").drop(ident)
    return by_id.unionByName(facts.join(loose, [*scope, name]), allowMissingColumns=True)
