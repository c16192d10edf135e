"""The four-level catalogue of majors from JSON responses (A-13), by Variant: levels of study, categories, subcategories, majors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What JSON holds for false, by its text: a response's flag that is one of these says that it failed.
_FALSE = r"^(?:false|null|\"\"|\[\]|\{\}|-?0+(?:\.0+)?(?:[eE][+-]?[0-9]+)?)$"


def _opened(spark: SparkSession, responses: DataFrame) -> DataFrame:
    """The responses with `_body` (Variant, null if no JSON object) and `reason`, why they can't be read."""
    body = responses.withColumn("_body", F.try_parse_json("payload"))
    flag = F.to_json(F.try_variant_get("_body", "$.flag", "variant"))
    kind = F.schema_of_variant("_body")
    message = F.schema_of_variant(F.try_variant_get("_body", "$.msg", "variant"))
    reason = (
        F.when(F.coalesce(F.col("payload"), F.lit("")) == "", "empty").when(F.col("_body").isNull(), "no JSON")
        .when(~F.startswith(kind, F.lit("OBJECT")) | F.coalesce(flag.rlike(_FALSE), F.lit(True)), "no flag")
        .when(~F.coalesce(F.startswith(message, F.lit("ARRAY")), F.lit(False)), "no list")
    )
    return body.withColumn("reason", reason)


def items(responses: DataFrame, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(a row for each object of a response's `msg`, rejects with their reason).

    responses: payload and any other columns, which stay. fields: column -> member of the object, as trimmed text; numbers by their JSON
    text, null where there is none. Elements that are no objects are left out.
    """
    spark, opened = responses.sparkSession, _opened(responses.sparkSession, responses)
    keep = [c for c in responses.columns if c != "payload"]
    good = opened.filter("reason IS NULL").select(*keep, F.try_variant_get("_body", "$.msg", "variant").alias("_msg"))
    each = spark.sql("SELECT r.*, i.pos AS place, i.value AS _item FROM {r} AS r, LATERAL variant_explode(r._msg) AS i", r=good).filter(F.startswith(F.schema_of_variant("_item"), F.lit("OBJECT")))
    own = [F.trim(F.try_variant_get("_item", f"$.{m}", "string")).alias(c) for c, m in fields.items()]
    return each.select(*keep, "place", *own), opened.filter("reason IS NOT NULL").select(*keep, "reason")


def walk(categories: DataFrame, subcategories: DataFrame, majors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(majors with their category, subcategory and level of study, rejected responses of all levels).

    Each table has a row for each response: the key that it was asked by (a level's, a category's, a subcategory's) and its payload;
    categories also the level's label, education_level. Objects without a key and a name are skipped, majors also without
    a code. A code may come in several responses of a level: the last one, by key and place, stays. A satisfaction of 0.0 is none.
    """
    named = {"code": "key", "name": "name"}
    top, bad_top = items(categories.select("education_level", F.col("key").alias("_under"), "payload"), named)
    mid, bad_mid = items(subcategories.select(F.col("key").alias("_under"), "payload"), named)
    leaf, bad_leaf = items(majors.select(F.col("key").alias("_under"), "payload"), {"code": "zydm", "name": "zymc", "source_id": "specId", "satisfaction": "zymyd"})
    there = "coalesce(code, '') <> '' AND coalesce(name, '') <> ''"
    top = top.filter(there).select("education_level", F.col("code").alias("category_code"), F.col("name").alias("category"))
    mid = mid.filter(there).select(F.col("_under").alias("category_code"), F.col("code").alias("subcategory_code"), F.col("name").alias("subcategory"))
    paths = top.distinct().join(mid.distinct(), "category_code")
    found = leaf.filter(there).withColumnRenamed("_under", "subcategory_code").join(paths, "subcategory_code")
    scored = F.when(~F.coalesce("satisfaction", F.lit("")).isin("", "0.0"), F.col("satisfaction")).alias("satisfaction")
    values = ["name", "source_id", scored, "category_code", "category", "subcategory_code", "subcategory"]
    last = F.max(F.struct(F.struct("subcategory_code", "category_code", "place").alias("at"), F.struct(*values).alias("v")))["v"]
    out = found.groupBy("education_level", "code").agg(last.alias("v")).select("education_level", "code", "v.*")
    bad = [b.select(F.lit(level).alias("level"), F.col("_under").alias("key"), "reason") for level, b in (("categories", bad_top), ("subcategories", bad_mid), ("majors", bad_leaf))]
    return out, bad[0].unionByName(bad[1]).unionByName(bad[2])
