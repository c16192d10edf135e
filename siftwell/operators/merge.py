"""Upserts and change data capture (B-1 to B-7, B-13, B-14, L-1 to L-9). All return new tables; nothing is changed in place."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions.hashing import canonical_json, content_hash
from siftwell.operators.latest import first_by
from siftwell.operators.scan import number


@dataclass(frozen=True)
class EntitySpec:
    """A table's natural key and how its upsert goes. null_safe: nulls of a key match each other (T1)."""

    table: str
    keys: tuple[str, ...]
    null_safe: bool = True
    preserve: tuple[str, ...] = ()
    conditional: dict = field(default_factory=dict)


def _on(a: DataFrame, b: DataFrame, spec: EntitySpec) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_{k}"]) if spec.null_safe else a[k] == b[f"_{k}"] for k in spec.keys])


def _prefixed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_{c}") for c in df.columns])


def upsert(current: DataFrame, incoming: DataFrame, spec: EntitySpec) -> DataFrame:
    """B-1, B-2, B-5: incoming replaces current by key. `preserve` keeps the old value where the new is null;
    `conditional` {column: predicate over incoming} takes the new value only where it holds."""
    old = _prefixed(current)
    merged = incoming.join(old, _on(incoming, old, spec), "left")
    hit = F.coalesce(*[F.col(f"_{k}").isNotNull() for k in spec.keys]) if not spec.null_safe else F.col("_hit")
    if spec.null_safe:
        old = old.withColumn("_hit", F.lit(True))
        merged = incoming.join(old, _on(incoming, old, spec), "left")
    out = []
    for c in current.columns:
        new = F.col(c) if c in incoming.columns else F.col(f"_{c}")
        if c in spec.preserve:
            new = F.coalesce(new, F.col(f"_{c}"))
        if c in spec.conditional:
            new = F.when(spec.conditional[c] | F.coalesce(~hit, F.lit(True)), new).otherwise(F.col(f"_{c}"))
        out.append(new.alias(c))
    new = _prefixed(incoming)
    rest = current.join(new, _on(current, new, spec), "left_anti")
    return rest.unionByName(merged.select(*out))


def upsert_guarded(current: DataFrame, incoming: DataFrame, spec: EntitySpec, allowed: Column) -> tuple[DataFrame, DataFrame]:
    """B-3: (table, refused rows). allowed: over incoming's columns and the old row's as _name; rows without an old one pass."""
    old = _prefixed(current).withColumn("_hit", F.lit(True))
    seen = incoming.join(old, _on(incoming, old, spec), "left").withColumn("_ok", F.coalesce(~F.col("_hit"), F.lit(True)) | F.coalesce(allowed, F.lit(False)))
    return upsert(current, seen.filter("_ok").select(*incoming.columns), spec), seen.filter("NOT _ok").select(*incoming.columns)


def insert_ignore(current: DataFrame, incoming: DataFrame, spec: EntitySpec) -> DataFrame:  # B-6
    old = _prefixed(current)
    return current.unionByName(incoming.join(old, _on(incoming, old, spec), "left_anti").select(*current.columns))


def promote_placeholders(current: DataFrame, incoming: DataFrame, ident: str, name: str) -> DataFrame:
    """B-4: a single placeholder (negative id) of the same name takes the new id, if that id is not there yet; the rest is upserted."""
    single = current.filter(F.col(ident) < 0).groupBy(name).agg(F.count("*").alias("_n"), F.min(ident).alias("_old")).filter("_n = 1").select(name, "_old")
    fresh = incoming.join(current.select(ident), ident, "left_anti")
    moved = fresh.join(single, name).select(F.col("_old").alias("_o"))
    kept = current.join(moved, current[ident] == moved["_o"], "left_anti")
    return upsert(kept, incoming, EntitySpec("", (ident,), null_safe=False))


def register_members(dim: DataFrame, names: DataFrame, ident: str, name: str, cut: int | None = None) -> DataFrame:
    """B-7: unknown names get ids after the largest, in order of the name; numbered in segments."""
    wanted = names.select((F.left(F.col(name), F.lit(cut)) if cut else F.col(name)).alias(name)).filter(F.col(name).isNotNull()).distinct()
    new = wanted.join(dim.select(name), name, "left_anti")
    top = dim.agg(F.coalesce(F.max(ident), F.lit(0)).alias("_top"))
    numbered = number(new, [], [F.col(name).asc()], "_rn").join(F.broadcast(top))  # one row
    return dim.select(ident, name).unionByName(numbered.select((F.col("_top") + F.col("_rn")).cast(dim.schema[ident].dataType).alias(ident), name))


def delete_duplicates(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:  # B-13
    return first_by(df, keys, order)


def reset_where_missing(current: DataFrame, evidence: DataFrame, keys: list[str], defaults: dict[str, Column]) -> DataFrame:
    """B-14, L-9: defaults where no evidence row has the key."""
    seen = evidence.select(*keys).distinct().withColumn("_hit", F.lit(True))
    joined = current.join(seen, keys, "left")
    return joined.select(*[F.when(F.col("_hit"), F.col(c)).otherwise(defaults[c]).alias(c) if c in defaults else F.col(c) for c in current.columns])


def three_state(current: DataFrame, incoming: DataFrame, spec: EntitySpec, seq: str | None = None, hash_col: str = "content_hash") -> DataFrame:
    """L-1 to L-3: incoming with change_type and previous_hash. "new" is decided by the row's absence, not by a
    null hash; with `seq`, a later row of a key in the batch is compared with the one before it."""
    old = current.select(*[F.col(k).alias(f"_{k}") for k in spec.keys], F.col(hash_col).alias("_hash"), F.lit(True).alias("_hit"))
    joined = incoming.join(old, _on(incoming, old, spec), "left")
    before, there = F.col("_hash"), F.coalesce(F.col("_hit"), F.lit(False))
    if seq:
        w = Window.partitionBy(*spec.keys).orderBy(seq)
        joined = joined.withColumn("_at", F.row_number().over(w)).withColumn("_lag", F.lag(hash_col).over(w))
        again = F.col("_at") > 1
        if not spec.null_safe:
            again = again & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in spec.keys])
        before, there = F.when(again, F.col("_lag")).otherwise(before), there | again
    kind = F.when(~there, "new").when(before.eqNullSafe(F.col(hash_col)), "unchanged").otherwise("updated")
    marked = joined.withColumn("change_type", kind).withColumn("previous_hash", F.when(F.col("change_type") == "updated", before))
    return marked.drop("_hash", "_hit", "_at", "_lag", *[f"_{k}" for k in spec.keys])


def snapshots(current: DataFrame, changes: DataFrame, spec: EntitySpec, entity: str, hash_col: str = "content_hash", seq: str | None = None) -> DataFrame:
    """L-2, B-8: the log rows; updated ones carry the old row as JSON, with `seq` that of the batch's row before."""
    if seq:
        w = Window.partitionBy(*spec.keys).orderBy(seq)
        own = canonical_json(changes.select(*[c for c in current.columns if c in changes.columns]))
        changes = changes.withColumn("_before", F.lag(own).over(w))
    old = current.select(*[F.col(k).alias(f"_{k}") for k in spec.keys], canonical_json(current).alias("_old"))
    joined = changes.join(old, _on(changes, old, spec), "left")
    data = F.when(F.col("change_type") == "updated", F.coalesce(F.col("_before"), F.col("_old")) if seq else F.col("_old"))
    return joined.select(F.lit(entity).alias("entity_type"), *spec.keys, F.col(hash_col), "change_type", "previous_hash", data.alias("snapshot_data"))


def change_counts(changes: DataFrame) -> DataFrame:  # E-12
    return changes.groupBy("change_type").agg(F.count("*").alias("n"))


def apply_changes(current: DataFrame, incoming: DataFrame, spec: EntitySpec, entity: str, seq: str | None = None, keep: Callable[[DataFrame], DataFrame] = lambda met: met) -> tuple[DataFrame, DataFrame]:
    """(table after, snapshot rows) of one batch; the same batch again is all unchanged.

    Without `seq` both come from one join, which `keep` may hold for the two to be written.

    seq: the order of a key's rows, ties by their hash, where keys may repeat. Each row is logged against
    the one before it and the last one is upserted; `seq` itself is no content, so it makes no change.
    """
    if seq:
        content = lambda df: content_hash(df.drop(seq))
        hashed = incoming.withColumn("content_hash", content(incoming))
        known = current if "content_hash" in current.columns else current.withColumn("content_hash", content(current))
        changes = three_state(known, hashed.withColumn("_order", F.struct(seq, "content_hash")), spec, "_order")
        w = Window.partitionBy(*spec.keys)
        changed = changes.withColumn("_last", F.row_number().over(w.orderBy(F.desc("_order"))) == 1).withColumn("_moved", F.max(F.col("change_type") != "unchanged").over(w))
        alone = F.lit(False) if spec.null_safe else reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.keys])
        moved = changed.filter(F.col("_moved") & (F.col("_last") | alone)).select(*[c for c in current.columns if c in changes.columns])
        return upsert(current, moved, spec), snapshots(current, changes, spec, entity, seq="_order")
    met = keep(_met(current, incoming, spec))
    return _after(met, current, [*incoming.columns, "content_hash"], spec), _logged(met, current, spec, entity)


def _met(current: DataFrame, incoming: DataFrame, spec: EntitySpec) -> DataFrame:
    """Rows of both sides by key, each side with its columns as one struct (`_old`, `_new`), null where it has none, with
    change_type and previous_hash as three_state gives them, null where nothing came in: one join, from which table and log follow.
    Rows are hashed after it, since hashes are wider than what most tables hold."""
    old, new = current.select(F.struct(*current.columns).alias("_old")), incoming.select(F.struct(*incoming.columns).alias("_new"))
    key = lambda side, k: F.col(f"{side}.{k}")
    on = reduce(lambda x, y: x & y, [key("_old", k).eqNullSafe(key("_new", k)) if spec.null_safe else key("_old", k) == key("_new", k) for k in spec.keys])
    met = old.join(new, on, "full")
    met = met.select("*", "_old.*")
    held = F.col("content_hash") if "content_hash" in current.columns else content_hash(met, current.columns)
    met = met.select("_old", "_new", F.when(F.col("_old").isNotNull(), held).alias("_before"))
    met = met.select("_old", "_new", "_before", "_new.*")
    came = [F.col(c) for c in incoming.columns if c != "content_hash"]
    met = met.select("_old", "_before", F.when(F.col("_new").isNotNull(), F.struct(*came, content_hash(met, incoming.columns).alias("content_hash"))).alias("_new"))
    kind = F.when(F.col("_old").isNull(), "new").when(F.col("_before").eqNullSafe(F.col("_new.content_hash")), "unchanged").otherwise("updated")
    met = met.withColumn("change_type", F.when(F.col("_new").isNotNull(), kind))
    return met.withColumn("previous_hash", F.when(F.col("change_type") == "updated", F.col("_before"))).drop("_before")


def _after(met: DataFrame, current: DataFrame, incoming: list[str], spec: EntitySpec) -> DataFrame:
    """The table as `upsert` of the changed rows leaves it."""
    moved, hit = F.coalesce(F.col("change_type") != "unchanged", F.lit(False)), F.col("_old").isNotNull()
    wide = met.select("_old", moved.alias("_moved"), hit.alias("_hit"), "_new.*")
    out = []
    for c in current.columns:
        was = F.col(f"_old.{c}")
        new = F.col(c) if c in incoming else was
        if c in spec.preserve:
            new = F.coalesce(new, was)
        if c in spec.conditional:
            new = F.when(spec.conditional[c] | ~F.col("_hit"), new).otherwise(was)
        out.append(F.when(F.col("_moved"), new).otherwise(was).alias(c))
    return wide.select(*out)


def _logged(met: DataFrame, current: DataFrame, spec: EntitySpec, entity: str) -> DataFrame:
    """The log rows as `snapshots` gives them."""
    came = met.filter("change_type IS NOT NULL")
    was = came.select("_old.*", "_new", "change_type", "previous_hash")
    data = F.when(F.col("change_type") == "updated", canonical_json(was, current.columns))
    return was.select(F.lit(entity).alias("entity_type"), *[F.col(f"_new.{k}").alias(k) for k in spec.keys], F.col("_new.content_hash").alias("content_hash"), "change_type", "previous_hash", data.alias("snapshot_data"))


def affected_groups(facts: DataFrame, touched: DataFrame, keys: list[str]) -> DataFrame:
    """L-8: all rows of the groups that a run touched."""
    return facts.join(touched.select(*keys).distinct(), keys, "left_semi")


def canonical_rows(df: DataFrame, name: str, external: str, ident: str) -> DataFrame:
    """L-12: one row per (name, external id), positive ids first, then the smallest; unmapped rows join the only mapped group."""
    groups = df.filter(F.col(external).isNotNull()).groupBy(name).agg(F.count_distinct(external).alias("_n"), F.min(external).alias("_only"))
    keyed = df.join(groups, name, "left").withColumn("_ext", F.coalesce(F.col(external), F.when(F.col("_n") == 1, F.col("_only"))))
    return first_by(keyed, [name, "_ext"], [(F.col(ident) > 0).desc(), F.col(ident)]).drop("_n", "_only", "_ext")
