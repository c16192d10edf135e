"""Readiness of a province's plans from the stored tables (M-16), by province code or name, with optional subject and batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.text import major_name_greedy
from siftwell.plans.readiness import FLAGS

#: Of an admission group: columns of `_history`.
FOUND = ["score_year", "score", "rank_year", "rank", "score_years", "rank_years", "max_score", "avg_score", "admitted"]


def target_province(provinces: DataFrame, wanted: str) -> DataFrame:
    """The province of that name, else of that code: province_id, province_code, province_name; a row at most."""
    hit = provinces.filter((F.col("name") == wanted) | (F.col("code") == wanted)).orderBy((F.col("name") == wanted).desc_nulls_last(), "id").limit(1)
    return hit.select(F.col("id").alias("province_id"), F.col("code").alias("province_code"), F.col("name").alias("province_name"))


def scoped(facts: DataFrame, target: DataFrame, subject: str | int | None, batch: str | None) -> DataFrame:
    """C-4, C-7: the province's rows, of a subject and of a batch or batch category where these are given."""
    here = [r.province_id for r in target.select("province_id").collect()]  # one at most; as a value the filter goes down to the tables
    out = facts.filter(F.col("province_id").isin(here)).join(F.broadcast(target), "province_id")
    if subject is not None:
        out = out.filter(F.col("subject_category_id").eqNullSafe(F.lit(subject)))
    return out if batch is None else out.filter((F.col("batch") == batch) | (F.col("batch_category") == batch))


def by_year(facts: DataFrame) -> DataFrame:
    """Admissions by school, major, name key and year: all that both ways of matching need, from one pass over the facts."""
    return facts.groupBy("school_id", "major_id", "_name", "year").agg(
        F.min("min_score").alias("s"), F.min("min_rank").alias("r"),
        *[F.bool_or(F.col(c).isNotNull()).alias(n) for c, n in (("max_score", "m"), ("avg_score", "a"), ("admitted_count", "n"))],
    )


def _history(years: DataFrame, key: str, prefix: str) -> DataFrame:
    def last(value: str) -> Column:
        return F.max(F.when(F.col(value).isNotNull(), F.struct("year", (-F.col(value)).alias("low"), F.col(value).alias("v"))))

    found = years.groupBy(F.col("school_id").alias(f"{prefix}school"), F.col(key).alias(f"{prefix}key")).agg(
        last("s").alias("ls"), last("r").alias("lr"), *[F.count_distinct(F.when(F.col(c).isNotNull(), F.col("year"))).alias(f"y{c}") for c in "sr"], *[F.bool_or(c).alias(c) for c in "man"],
    )
    values = [F.col("ls.year"), F.col("ls.v"), F.col("lr.year"), F.col("lr.v"), F.col("ys"), F.col("yr"), F.col("m"), F.col("a"), F.col("n")]
    return found.select(f"{prefix}school", f"{prefix}key", F.struct(*[v.alias(n) for v, n in zip(values, FOUND)]).alias(f"{prefix}found"))


def strength(school_majors: DataFrame, signals: DataFrame) -> DataFrame:
    """School and major with evidence of strength: featured, ranked, scored, or with a signal."""
    own = school_majors.select("school_id", "major_id", (F.coalesce("is_featured_major", F.lit(False)) | F.col("major_strength_rank").isNotNull() | F.col("major_strength_score").isNotNull()).alias("own"))
    seen = signals.select("school_id", "major_id").distinct().withColumn("_signal", F.lit(True))
    return own.join(seen, ["school_id", "major_id"], "left").filter("own OR _signal").select(F.col("school_id").alias("_ss"), F.col("major_id").alias("_sm")).distinct().withColumn("_strong", F.lit(True))


def answer_readiness(provinces: DataFrame, plans: DataFrame, results: DataFrame, schools: DataFrame, majors: DataFrame, school_majors: DataFrame, signals: DataFrame, province: str, year: int, years: list[int], subject: str | int | None = None, batch: str | None = None) -> DataFrame:
    """A row for each plan: its match with past admissions (by major_id, else by normalized name), what those hold, and what is missing.

    The match by id wins as a block, even with empty values, and alone counts as linkage. A plan without a major's id meets
    admissions without one. A scope without plans has no rows.
    """
    target = target_province(provinces, province)
    names = majors.select(F.col("id").alias("major_id"), F.col("name").alias("_major"))
    own = scoped(plans.filter(F.col("year") == year), target, subject, batch).join(names, "major_id", "left")
    own = own.withColumn("major_name", F.coalesce("_major", "major_name")).withColumn("_key", major_name_greedy("major_name"))
    facts = scoped(results.filter(F.col("year").isin(years)), target, subject, batch).join(names, "major_id", "left")
    held = by_year(facts.withColumn("_name", major_name_greedy(F.coalesce("major_name_raw", "_major"))))
    exact, named = _history(held, "major_id", "e_"), _history(held.filter("_name <> ''"), "_name", "n_")
    at = own.join(schools.select(F.col("id").alias("school_id"), F.col("name").alias("school_name")), "school_id")
    at = at.join(exact, (at.school_id == exact.e_school) & at.major_id.eqNullSafe(exact.e_key), "left")
    at = at.join(named, (at.school_id == named.n_school) & (at["_key"] == named.n_key), "left")
    strong = strength(school_majors, signals)
    at = at.join(strong, (at.school_id == strong["_ss"]) & at.major_id.eqNullSafe(strong["_sm"]), "left")
    at = at.withColumn("_f", F.coalesce("e_found", "n_found"))
    kind = F.when(F.col("e_found").isNotNull(), "major_id").when(F.col("n_found").isNotNull(), "normalized_name")
    count = lambda c: F.coalesce(F.col(f"_f.{c}"), F.lit(0)).cast("int")
    told = lambda c: F.coalesce(F.col(f"_f.{c}"), F.lit(False))
    asked = ["plan_count", "major_group_code", "major_code_raw", "selection_requirement"]
    missing = [*[F.col(c).isNull() for c in asked], F.col("e_found").isNull(), count("score_years") < len(years), count("rank_years") < len(years), F.col("_strong").isNull()]
    listed = lambda c: F.array_compact(F.array(c))
    return at.select(
        "province_code", "province_name", F.lit(year).alias("plan_year"), "school_id", "school_name", F.col("id").alias("enrollment_plan_id"), "major_id", "major_name", "plan_count",
        *[listed(c).alias(f"{c}s") for c in asked[1:]], kind.alias("admission_match_type"),
        F.col("_f.score_year").alias("latest_min_score_year"), F.col("_f.score").alias("latest_min_score"), F.col("_f.rank_year").alias("latest_min_rank_year"), F.col("_f.rank").alias("latest_min_rank"),
        count("score_years").alias("years_with_min_score"), count("rank_years").alias("years_with_min_rank"), *[told(c).alias(f"has_{n}") for c, n in (("max_score", "max_score"), ("avg_score", "avg_score"), ("admitted", "admitted_count"))],
        F.col("_strong").isNotNull().alias("has_strength_evidence"), F.array_compact(F.array(*[F.when(m, f) for m, f in zip(missing, FLAGS)])).alias("readiness_flags"),
    )
