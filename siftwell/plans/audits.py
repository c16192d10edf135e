"""Audits of the stored tables (M-14 to M-19): a province by name or code, years, optional subject and batch.

Each takes the tables as a dict: provinces, schools, majors, enrollment_plans, major_admission_results, school_majors and
school_major_strength_signals. A province that is not there gives zeros in counts of one row, and no rows else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.text import json_filled, major_name_greedy
from siftwell.operators.rounds import cut
from siftwell.plans.answer_readiness import answer_readiness, by_year, scoped, target_province
from siftwell.plans.readiness import FLAGS

PLANS, RESULTS, TAUGHT, SIGNALS = "enrollment_plans", "major_admission_results", "school_majors", "school_major_strength_signals"
#: Columns whose presence is counted, in admissions and in plans.
COUNTED = {"admission": ["plan_count", "major_group_code"], "plan": ["plan_count", "major_group_code", "selection_requirement"]}


def _measures(kind: str) -> list[Column]:
    out = [F.count("*").alias(f"{kind}_records"), *[F.count(c).alias(f"{kind}_records_with_{c}") for c in COUNTED[kind]], F.count_distinct("major_id").alias(f"{kind}_majors")]
    return out + [F.coalesce(F.sum("plan_count"), F.lit(0)).alias("plan_count_sum")] if kind == "plan" else out


def _names(kind: str) -> list[str]:
    return [f"{kind}_records", *[f"{kind}_records_with_{c}" for c in COUNTED[kind]], f"{kind}_majors", *(["plan_count_sum"] if kind == "plan" else [])]


def year_coverage(tables: dict[str, DataFrame], province: str, years: list[int]) -> DataFrame:
    """M-14: a row for each year, also without facts: what admissions and plans there are, and how many schools lack plans."""
    target = target_province(tables["provinces"], province)
    schools = lambda kind: F.count_distinct("school_id").alias(f"{kind}_schools")
    a = scoped(tables[RESULTS].filter(F.col("year").isin(years)), target, None, None).groupBy("year").agg(schools("admission"), *_measures("admission"))
    p = scoped(tables[PLANS].filter(F.col("year").isin(years)), target, None, None).groupBy("year").agg(schools("plan"), *_measures("plan"))
    kind = tables[RESULTS].schema["year"].dataType
    grid = target.select("province_code", "province_name", F.explode(F.array(*[F.lit(y).cast(kind) for y in sorted(set(years))])).alias("year"))
    counts = ["admission_schools", *_names("admission"), "plan_schools", *_names("plan")]
    out = grid.join(a, "year", "left").join(p, "year", "left").fillna(0, counts)
    return out.withColumn("missing_plan_schools", F.greatest(F.col("admission_schools") - F.col("plan_schools"), F.lit(0)))


def plan_gaps(tables: dict[str, DataFrame], province: str, years: list[int], limit: int = 50) -> DataFrame:
    """M-15: schools and years with admissions and without plans, the last years and most admissions first."""
    target = target_province(tables["provinces"], province)
    a = scoped(tables[RESULTS].filter(F.col("year").isin(years)), target, None, None).groupBy("province_code", "province_name", "school_id", "year").agg(*_measures("admission"))
    p = scoped(tables[PLANS].filter(F.col("year").isin(years)), target, None, None).select("school_id", "year").distinct()
    names = tables["schools"].select(F.col("id").alias("school_id"), F.col("name").alias("school_name"))
    gaps = a.join(p, ["school_id", "year"], "left_anti").join(names, "school_id").withColumns({n: F.lit(0).cast("bigint") for n in _names("plan")})
    return gaps.orderBy(F.col("year").desc(), F.col("admission_records").desc(), F.col("school_name").asc_nulls_last(), "school_id").limit(limit)


def readiness(tables: dict[str, DataFrame], province: str, plan_year: int, years: list[int], subject: str | int | None = None, batch: str | None = None) -> DataFrame:
    """M-16: a row for each plan, with what is missing and whether it is ready."""
    t = tables
    found = answer_readiness(t["provinces"], t[PLANS], t[RESULTS], t["schools"], t["majors"], t[TAUGHT], t[SIGNALS], province, plan_year, sorted(set(years)), subject, batch)
    return found.withColumn("answer_ready", F.size("readiness_flags") == 0)


def readiness_gaps(ready: DataFrame, limit: int = 50) -> DataFrame:
    """M-16: plans that aren't ready, those that lack most first."""
    return ready.filter(~F.col("answer_ready")).orderBy(F.size("readiness_flags").desc(), F.col("school_name").asc_nulls_last(), F.col("major_name").asc_nulls_last(), "enrollment_plan_id").limit(limit)


def readiness_summary(ready: DataFrame) -> DataFrame:
    """M-17: one row, also where there are no plans."""
    return ready.agg(
        F.count("*").alias("plan_major_count"), F.count_if("answer_ready").alias("answer_ready_count"), F.count_if(~F.col("answer_ready")).alias("gap_count"),
        *[F.count_if(F.array_contains("readiness_flags", f)).alias(f) for f in FLAGS],
    )


def _plan_majors(tables: dict[str, DataFrame], target: DataFrame, year: int, subject: str | int | None, batch: str | None) -> DataFrame:
    """The year's school_id, major_id and name of the major, each once, with the name's key."""
    names = tables["majors"].select(F.col("id").alias("major_id"), F.col("name").alias("_major"))
    plans = scoped(tables[PLANS].filter(F.col("year") == year), target, subject, batch).join(names, "major_id", "left")
    return plans.select("school_id", "major_id", F.coalesce("_major", "major_name").alias("major_name")).distinct().withColumn("_key", major_name_greedy("major_name"))


def match_diagnostics(tables: dict[str, DataFrame], province: str, plan_year: int, years: list[int], subject: str | int | None = None, batch: str | None = None) -> DataFrame:
    """M-18: how many of the year's plan majors meet admissions by id, by name, by name alone and not at all; one row.

    Admissions are summed by school, major, name and year before either way of matching; a plan without id meets admissions
    without one.
    """
    target = target_province(tables["provinces"], province)
    names = tables["majors"].select(F.col("id").alias("major_id"), F.col("name").alias("_major"))
    facts = scoped(tables[RESULTS].filter(F.col("year").isin(years)), target, subject, batch).join(names, "major_id", "left")
    held = by_year(facts.withColumn("_name", major_name_greedy(F.coalesce("major_name_raw", "_major"))))
    seen = lambda p: [F.lit(True).alias(f"{p}hit"), F.bool_or(F.col("s").isNotNull()).alias(f"{p}score"), F.bool_or(F.col("r").isNotNull()).alias(f"{p}rank")]
    exact = held.groupBy(F.col("school_id").alias("e_school"), F.col("major_id").alias("e_key")).agg(*seen("e_"))
    named = held.filter("_name <> ''").groupBy(F.col("school_id").alias("n_school"), F.col("_name").alias("n_key")).agg(*seen("n_"))
    own = _plan_majors(tables, target, plan_year, subject, batch)
    at = own.join(exact, (own.school_id == exact.e_school) & own.major_id.eqNullSafe(exact.e_key), "left")
    at = at.join(named, (at.school_id == named.n_school) & (at["_key"] == named.n_key), "left")
    out = [F.count("*").alias("plan_major_count"), F.count("major_id").alias("plan_major_with_major_id_count")]
    for of, name, alone in (("e_", "exact_major_id_match", F.lit(True)), ("n_", "normalized_name_match", F.lit(True)), ("n_", "normalized_name_only_match", F.col("e_hit").isNull())):
        out += [F.count_if(F.col(f"{of}{c}") & alone).alias(f"{name}{suffix}_count") for c, suffix in (("hit", ""), ("score", "_with_min_score"), ("rank", "_with_min_rank"))]
    return at.agg(*out, F.count_if(F.col("e_hit").isNull() & F.col("n_hit").isNull()).alias("unmatched_plan_major_count"))


def strength_diagnostics(tables: dict[str, DataFrame], province: str, plan_year: int, subject: str | int | None = None, batch: str | None = None) -> DataFrame:
    """M-19: how many of the year's plan majors the school teaches, have signals, a roll-up, or signals without a roll-up; one row."""
    own = cut(_plan_majors(tables, target_province(tables["provinces"], province), plan_year, subject, batch))
    schools = own.select("school_id").distinct()  # all that is taught and signalled elsewhere is left out before it is grouped
    rolled = F.col("major_strength_rank").isNotNull() | F.col("major_strength_score").isNotNull() | F.coalesce("is_featured_major", F.lit(False)) | json_filled("strength_evidence")
    taught = tables[TAUGHT].join(schools, "school_id", "left_semi").groupBy(F.col("school_id").alias("t_school"), F.col("major_id").alias("t_major")).agg(F.bool_or(rolled).alias("rolled"))
    signals = tables[SIGNALS].join(F.broadcast(schools), "school_id", "left_semi").select(F.col("school_id").alias("g_school"), F.col("major_id").alias("g_major"), F.lit(True).alias("signal")).distinct()
    at = own.join(taught, (own.school_id == taught.t_school) & own.major_id.eqNullSafe(taught.t_major), "left")
    at = at.join(signals, (at.school_id == signals.g_school) & at.major_id.eqNullSafe(signals.g_major), "left")
    up = F.coalesce("rolled", F.lit(False))
    return at.agg(
        F.count("*").alias("plan_major_count"), F.count("t_school").alias("plan_major_with_school_major_count"), F.count("signal").alias("plan_major_with_strength_signal_count"),
        F.count_if(up).alias("plan_major_with_strength_rollup_count"), F.count_if(F.col("signal") & ~up).alias("plan_major_signal_without_rollup_count"),
    )
