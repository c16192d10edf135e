"""Coverage, gaps, readiness and diagnostics (M-14 to M-19), over admission and plan facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.operators.latest import latest_value

FLAGS = ["missing_plan_count", "missing_major_group_code", "missing_major_code_raw", "missing_selection_requirement", "missing_admission_linkage", "missing_admission_min_score", "missing_admission_min_rank", "missing_strength_evidence"]


def year_coverage(adm: DataFrame, plans: DataFrame, province: int, years: list[int]) -> DataFrame:  # M-14
    spark = adm.sparkSession
    grid = spark.createDataFrame([(y,) for y in years], "yr long")
    scope = (F.col("province") == province) & F.col("yr").isin(years)
    a = adm.filter(scope).groupBy("yr").agg(
        F.count("*").alias("admission_records"), F.count_distinct("school_id").alias("admission_schools"),
        F.count_if(F.col("min_score").isNotNull()).alias("with_score"), F.count_if(F.col("min_rank").isNotNull()).alias("with_rank"),
    )
    p = plans.filter(scope).groupBy("yr").agg(F.count("*").alias("plan_records"), F.count_distinct("school_id").alias("plan_schools"))
    out = grid.join(a, "yr", "left").join(p, "yr", "left").fillna(0)
    return out.withColumn("missing_plan_schools", F.greatest(F.col("admission_schools") - F.col("plan_schools"), F.lit(0)))


def plan_gaps(adm: DataFrame, plans: DataFrame, province: int, years: list[int], limit: int, names: DataFrame) -> DataFrame:
    """M-15: schools and years with admissions and no plans. names: school_id, school_name."""
    scope = (F.col("province") == province) & F.col("yr").isin(years)
    a = adm.filter(scope).groupBy("school_id", "yr").agg(F.count("*").alias("admission_records"))
    gaps = a.join(plans.filter(scope).select("school_id", "yr").distinct(), ["school_id", "yr"], "left_anti")
    order = [F.col("yr").desc(), F.col("admission_records").desc(), "school_name", "school_id"]
    return gaps.join(names, "school_id").orderBy(*order).limit(limit)


def _history(adm: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    score, rank = F.col("min_score").isNotNull(), F.col("min_rank").isNotNull()
    return adm.groupBy(*keys).agg(
        F.count_distinct(F.when(score, F.col("yr"))).alias(f"{prefix}score_years"), F.count_distinct(F.when(rank, F.col("yr"))).alias(f"{prefix}rank_years"),
        latest_value("min_score", "yr").alias(f"{prefix}score"), latest_value("min_rank", "yr").alias(f"{prefix}rank"), F.lit(True).alias(f"{prefix}hit"),
    )


def readiness(plans: DataFrame, adm: DataFrame, strength: DataFrame, years: list[int], name_key: Column, adm_name_key: Column) -> DataFrame:
    """M-16: plans with match_type, latest score and rank, flags and answer_ready.

    plans: school_id, plan_major, plan_count, group_code, code_raw, requirement; strength: school_id, plan_major.
    The exact match wins as a block, even with empty values; the linkage flag looks at it alone (T10).
    """
    exact = _history(adm.filter(F.col("yr").isin(years)), ["school_id", "major_id"], "e_")
    named = _history(adm.filter(F.col("yr").isin(years)).withColumn("_name", adm_name_key).filter("_name <> ''"), ["school_id", "_name"], "n_")
    e = exact.withColumnRenamed("school_id", "_es")
    p = plans.withColumn("_key", name_key)
    j = p.join(e, (p.school_id == e["_es"]) & p.plan_major.eqNullSafe(e["major_id"]), "left").drop("_es", "major_id")
    n = named.withColumnRenamed("school_id", "_ns")
    j = j.join(n, (j.school_id == n["_ns"]) & (j["_key"] == n["_name"]) & (j["_key"] != ""), "left").drop("_ns", "_name")
    s = strength.select("school_id", "plan_major").distinct().withColumn("_strong", F.lit(True))
    j = j.join(s, ["school_id", "plan_major"], "left")
    ex = F.coalesce("e_hit", F.lit(False))
    v = lambda c: F.when(ex, F.col(f"e_{c}")).otherwise(F.col(f"n_{c}"))
    j = j.withColumn("match_type", F.when(ex, "exact").when(F.col("n_hit"), "name").otherwise("none"))
    j = j.withColumn("latest_score", v("score")).withColumn("latest_rank", v("rank"))
    want = len(years)
    checks = [F.col("plan_count").isNull(), F.col("group_code").isNull(), F.col("code_raw").isNull(), F.col("requirement").isNull(), ~ex, F.coalesce(v("score_years"), F.lit(0)) < want, F.coalesce(v("rank_years"), F.lit(0)) < want, F.col("_strong").isNull()]
    j = j.withColumn("flags", F.array_compact(F.array(*[F.when(c, f) for c, f in zip(checks, FLAGS)])))
    return j.withColumn("answer_ready", F.size("flags") == 0)


def readiness_gaps(ready: DataFrame, limit: int, order: list) -> DataFrame:
    return ready.filter("NOT answer_ready").orderBy(F.size("flags").desc(), *order).limit(limit)


def readiness_summary(ready: DataFrame) -> DataFrame:  # M-17: a row even if there are no plans
    return ready.agg(F.count("*").alias("plans"), F.count_if("answer_ready").alias("answer_ready"), F.count_if(F.col("match_type") == "exact").alias("exact"), F.count_if(F.col("match_type") == "name").alias("by_name"), *[F.count_if(F.array_contains("flags", f)).alias(f) for f in FLAGS])
