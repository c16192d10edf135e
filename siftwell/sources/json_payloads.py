"""JSON payloads in their three shapes, dictionaries and catalogues (A-9 to A-13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def objects(x: Column, ddl: str) -> Column:
    """The objects of a JSON array as structs; elements of another kind go, what is no array has none."""
    each = F.filter(F.from_json(x, "array<string>"), lambda e: F.startswith(F.ltrim(e), F.lit("{")))
    return F.coalesce(F.transform(each, lambda e: F.from_json(e, ddl)), F.array().cast(f"array<{ddl}>"))


def plan_items(payloads: DataFrame, column: str, item: str) -> DataFrame:
    """A-9: a row per item of `data` as a list, as {item: [...]}, or as groups of {item: [...]}. item: a DDL struct."""
    data = F.get_json_object(column, "$.data")
    as_list = objects(data, item)
    direct = F.from_json(data, f"struct<item: array<{item}>>")["item"]
    groups = F.flatten(F.transform(F.map_values(F.from_json(data, f"map<string, struct<item: array<{item}>>>")), lambda g: F.coalesce(g["item"], F.array().cast(f"array<{item}>"))))
    found = F.when(F.startswith(data, F.lit("[")), as_list).otherwise(F.coalesce(direct, groups))
    return payloads.withColumn("_item", F.explode(found)).select(*payloads.columns, "_item.*")


def allowed_years(table: Column, province: Column, years: list[int]) -> Column:
    """A-11: a province's years within the allowed ones; all of those where the dictionary is empty."""
    allowed = F.array(*map(F.lit, years))
    return F.when(F.size(table) == 0, allowed).otherwise(F.array_intersect(F.coalesce(F.try_element_at(table, province), F.array().cast("array<int>")), allowed))


def pages(total: Column, size: int = 20) -> Column:
    """A-10: page numbers from 1."""
    return F.when(total > 0, F.sequence(F.lit(1), F.ceil(total / size).cast("int"))).otherwise(F.array().cast("array<int>"))


def name_index(df: DataFrame, names: list[str], ident: str) -> DataFrame:
    """A-12: name and id over several name columns; the first column, then the smallest id wins."""
    each = F.posexplode(F.array(*[F.nullif(F.trim(F.col(n)), F.lit("")) for n in names])).alias("_pos", "name")
    return df.select(ident, each).filter("name IS NOT NULL").groupBy("name").agg(F.min(F.struct("_pos", ident)).getField(ident).alias(ident))
