"""Content hashes, synthetic ids and quality flags (I-53 to I-55, constraints of §1.4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields that are not content.
META = ("id", "created_at", "updated_at", "crawl_task_id", "content_hash")


def _json_value(df: DataFrame, name: str) -> Column:
    kind, c = df.schema[name].dataType.simpleString(), F.col(name)
    if kind == "boolean" or kind in ("tinyint", "smallint", "int", "bigint"):
        text = c.cast("string")
    else:
        one = F.to_json(F.struct(c.cast("string").alias("v")))
        text = F.replace(F.substr(one, F.lit(6), F.length(one) - 6), F.lit("\\/"), F.lit("/"))
    return F.when(c.isNull(), "null").otherwise(text)


def canonical_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Sorted keys, `", "` and `": "`, non-ASCII kept, meta fields left out; other types by their text."""
    names = sorted(c for c in columns or df.columns if c not in META)
    return F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{n}": '), _json_value(df, n)) for n in names]), F.lit("}"))


def content_hash(df: DataFrame, columns: list[str] | None = None) -> Column:  # I-53
    return F.sha2(canonical_json(df, columns), 256)


def synthetic_id(name: Column, span: int = 2_000_000_000) -> Column:  # I-54; operators.claims.place settles collisions
    return -(F.conv(F.substr(F.sha2(name, 256), F.lit(1), F.lit(8)), 16, 10).cast("bigint") % span + 1)


def missing_flags(df: DataFrame, columns: list[str]) -> Column:  # I-55: null, '' and empty collections, not 0 or false
    def missing(n: str) -> Column:
        kind = df.schema[n].dataType.simpleString()
        empty = F.col(n) == "" if kind == "string" else F.size(n) == 0 if kind.startswith(("array", "map")) else F.lit(False)
        return F.col(n).isNull() | F.coalesce(empty, F.lit(False))

    return F.array_compact(F.array(*[F.when(missing(n), f"missing_{n}") for n in columns]))


def validate(df: DataFrame, constraints: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects with `errors`: the names of broken constraints, never values)."""
    broken = [F.when(~F.coalesce(c, F.lit(False)), n) for n, c in constraints.items()]
    marked = df.withColumn("errors", F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>"))
    return marked.filter(F.size("errors") == 0).drop("errors"), marked.filter(F.size("errors") > 0)
