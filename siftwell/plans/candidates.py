"""The candidate admission chain (M-9) and the strength roll-up (M-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions import classify
from siftwell.operators.latest import ordered_list
from siftwell.operators.rounds import cut

#: Fixed names. Of both plans and admissions: columns told by their least and by their greatest value; then those of plans alone.
LEAST = ["major_group_code", "major_code_raw", "campus"]
GREATEST = ["batch", "batch_code", "program_type", "eligibility_requirements", "physical_exam_or_political_review", "political_review_requirement", "service_obligation"]
OF_PLANS = ["selection_requirement", "physical_exam_limit", "single_subject_limit", "adjustment_rule", "tuition", "education_location"]
#: Fixed names: what is listed of each plan, of each admission, and told of a school's major.
OPTION = ["year", "batch", "batch_code", "batch_category", "batch_segment", "major_group_code", "major_code_raw", "major_name", "plan_count", *OF_PLANS[:4], *GREATEST[2:], "tuition", "campus", "education_location"]
PAST = ["year", "batch", "batch_code", "major_group_code", "major_code_raw", "campus", "min_score", "min_rank", "admitted_count", "plan_count"]
STRENGTH = ["school_major_display_order", "major_strength_rank", "major_strength_score", "major_strength_tier", "is_featured_major", "strength_evidence"]


def candidate_chain(adm: DataFrame, plans: DataFrame, schools: DataFrame, majors: DataFrame, province: int, year: int, subject: str | None, batch: Column, rank: int, window: int = 5000, years_back: int = 3) -> DataFrame:
    """Majors whose past ranks are near `rank`, with this year's plans and their history.

    batch: the compatibility predicate. adm: school_id, major_id, major_name, yr, subject, min_rank, min_score; plans the
    same with plan_major, which may be null; then they match by name unless an identified sibling has it (D-14).
    """
    past = (F.col("province") == province) & F.col("yr").between(year - years_back, year - 1) & F.col("subject").eqNullSafe(F.lit(subject)) & batch
    facts = adm.filter(past)
    near = F.col("min_rank").between(max(1, rank - window), rank + window)
    matched = facts.filter(near).select("school_id", "major_id", "major_name").distinct()
    single = matched.groupBy("school_id", "major_name").agg(F.count_distinct("major_id").alias("n"), F.min("major_id").alias("major_id")).filter("n = 1").drop("n")
    now = plans.filter((F.col("province") == province) & (F.col("yr") == year) & F.col("subject").eqNullSafe(F.lit(subject)) & batch)
    keys = matched.select("school_id", "major_id").distinct()
    known = now.filter(F.col("plan_major").isNotNull())
    by_id = known.withColumnRenamed("plan_major", "major_id").join(keys, ["school_id", "major_id"], "left_semi").select("school_id", "major_id", "major_name", "plan_count")
    siblings = known.select("school_id", "batch", "major_name").distinct()
    loose = now.filter(F.col("plan_major").isNull()).join(siblings, ["school_id", "batch", "major_name"], "left_anti")
    by_name = loose.join(single, ["school_id", "major_name"]).select("school_id", "major_id", "major_name", "plan_count")
    current = by_id.unionByName(by_name).groupBy("school_id", "major_id").agg(F.sum("plan_count").alias("plan_count"), F.count("*").alias("plan_options"))
    years = facts.join(keys, ["school_id", "major_id"], "left_semi").groupBy("school_id", "major_id", "yr").agg(F.min("min_rank").alias("r"), F.min("min_score").alias("s"), F.min(F.abs(F.col("min_rank") - rank)).alias("d"))
    text = F.concat_ws(":", F.col("yr"), F.coalesce(F.col("s").cast("string"), F.lit("-")), F.coalesce(F.col("r").cast("string"), F.lit("-")))
    history = years.groupBy("school_id", "major_id").agg(F.array_join(ordered_list([-F.col("yr")], text), ";").alias("history"), F.min("d").alias("rank_distance"))
    out = keys.join(schools, "school_id").join(majors, "major_id").join(current, ["school_id", "major_id"], "left").join(history, ["school_id", "major_id"], "left")
    return out.orderBy(F.col("rank_distance").asc_nulls_last(), "school_name", "major_name", "school_id", "major_id")


def in_batch(batch: str) -> Column:
    """C-8: rows of the batch as it is written, or of the same code, category and segment, where nulls are equal."""
    read = classify.batch(F.lit(batch))
    same = [F.col(f"batch_{part}").eqNullSafe(read[part]) for part in ("code", "category", "segment")]
    return (F.col("batch") == batch) | (same[0] & same[1] & same[2])


def admission_chain(results: DataFrame, plans: DataFrame, schools: DataFrame, majors: DataFrame, school_majors: DataFrame, province_id: int, year: int, subject: str | int | None, batch: str, rank: int, window: int = 5000, years_back: int = 3) -> DataFrame:
    """M-9 from the stored tables: a row for each school and major that once admitted near `rank`, with all its admissions of those
    years and this year's plans; without order (in_chain_order).

    The admissions are read once: each group tells its history and whether any of it was near. Plans without a major's id count
    for the only candidate of their school and name, unless an identified plan of the same batch has that name. Lists hold
    structs: options by codes and name (nulls last), admissions by year from the last, equal ones by their values.
    """
    here = (F.col("province_id") == province_id) & F.col("subject_category_id").eqNullSafe(F.lit(subject))
    near = F.coalesce(F.col("min_rank").between(max(1, rank - window), rank + window), F.lit(False))
    told = [*[F.min(c).alias(c) for c in LEAST], *[F.max(c).alias(c) for c in GREATEST]]
    facts = results.filter(here & F.col("year").between(year - years_back, year - 1) & in_batch(batch) & F.col("major_id").isNotNull())
    past = facts.groupBy("school_id", "major_id").agg(
        F.bool_or(near).alias("_near"), F.max("school_code_raw").alias("school_code_raw"), F.max("plan_count").alias("historical_plan_count"), *told,
        ordered_list([-F.col("year")], F.struct(*PAST)).alias("admission_history"), F.min(F.abs(F.col("min_rank") - rank)).alias("rank_distance"),
    )
    named = majors.select(F.col("id").alias("major_id"), F.col("code").alias("major_code"), F.col("name").alias("major_name"))
    past = cut(past.filter("_near").drop("_near").join(named, "major_id"))  # read three times
    now = plans.filter(here & (F.col("year") == year))
    asked = now.filter(in_batch(batch))
    only = past.groupBy("school_id", "major_name").agg(F.count("*").alias("_n"), F.min("major_id").alias("major_id")).filter("_n = 1").drop("_n")
    identified = now.filter(F.col("major_id").isNotNull()).select("school_id", "batch", "major_name").distinct()
    loose = asked.filter(F.col("major_id").isNull()).drop("major_id").join(identified, ["school_id", "batch", "major_name"], "left_anti").join(only, ["school_id", "major_name"])
    known = asked.join(past.select("school_id", "major_id"), ["school_id", "major_id"], "left_semi")
    wanted = [c for c in dict.fromkeys(["school_id", "major_id", *LEAST, *GREATEST, *OF_PLANS, *OPTION])]
    by_code = [x for c in ("major_group_code", "major_code_raw", "major_name") for x in (F.col(c).isNull(), F.col(c))]
    current = known.select(*wanted).unionByName(loose.select(*wanted)).groupBy("school_id", "major_id").agg(
        F.sum("plan_count").alias("current_plan_count"), ordered_list(by_code, F.struct(*OPTION)).alias("current_plan_options"), *told, *[F.max(c).alias(c) for c in OF_PLANS],
    )
    shared = [*LEAST, *GREATEST]
    current = current.withColumnsRenamed({c: f"_now_{c}" for c in shared})
    at = schools.select(F.col("id").alias("school_id"), F.col("name").alias("school_name"), F.col("city").alias("school_city"))
    out = past.join(at, "school_id").join(school_majors.select("school_id", "major_id", *STRENGTH), ["school_id", "major_id"], "left").join(current, ["school_id", "major_id"], "left")
    first = {c: F.coalesce(f"_now_{c}", c) for c in shared} | {"is_featured_major": F.coalesce("is_featured_major", F.lit(False))}
    first["batch"] = F.coalesce("_now_batch", "batch", F.lit(batch))
    return out.withColumns(first).drop(*[f"_now_{c}" for c in shared])


def in_chain_order() -> list[Column]:
    """Nearest first, then the stronger major, then by names and ids."""
    last = [F.col(c).asc_nulls_last() for c in ("rank_distance", "major_strength_rank")]
    return [*last, F.col("major_strength_score").desc_nulls_last(), F.col("school_major_display_order").asc_nulls_last(), "school_name", "major_name", "school_id", "major_id"]


def strength_rollup(signals: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """M-10: per school and major the summed score, ordered evidence, rank in the school, tier and featured.

    signals: school_id, major_id, signal_type, score, evidence_year. touched (school_id): only those schools, whole (L-8).
    """
    if touched is not None:
        signals = signals.join(touched.select("school_id").distinct(), "school_id", "left_semi")
    item = F.concat_ws(":", "signal_type", "evidence_year", "score")
    grouped = signals.groupBy("school_id", "major_id").agg(F.sum("score").alias("strength_score"), F.array_join(ordered_list([-F.col("score"), F.col("signal_type"), F.col("evidence_year")], item), ";").alias("evidence"))
    w = Window.partitionBy("school_id").orderBy(F.col("strength_score").desc_nulls_first(), "major_id")
    ranked = grouped.withColumn("strength_rank", F.row_number().over(w).cast("bigint"))
    tier = F.when(F.col("strength_score") >= 100, "national").when(F.col("strength_score") >= 70, "provincial").otherwise("evidence")
    return ranked.withColumn("tier", tier).withColumn("is_featured", F.col("strength_rank") <= 3)
