"""The wide export (M-11, M-12): four reads of stored tables, and rows of 65 cells by their place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions import classify, text
from siftwell.operators.latest import pick
from siftwell.operators.rounds import cut
from siftwell.plans.history import match_history

#: The site whose rows count as official; where a school's charters are listed.
OFFICIAL, CHARTERS = "gaokao.chsi.com.cn", "https://gaokao.chsi.com.cn/zsgs/zhangcheng/listZszc--schId-"
#: Cells of the base block, of a past year's block, and of the school's block.
BASE, PAST, SCHOOL = 20, 5, 25


def _named(df: DataFrame, key: str, out: str) -> DataFrame:
    return df.select(F.col("id").alias(key), F.col("name").alias(out))


def _of_subject(subject: str | None) -> Column:
    """All, or those of a subject, with or without its last sign."""
    return F.lit(True) if subject is None else F.replace(F.coalesce("subject_category", F.lit("")), F.lit("类"), F.lit("")) == subject.replace("类", "")


def _facts(facts: DataFrame, provinces: DataFrame, subjects: DataFrame, majors: DataFrame, province: str, years: list[int], subject: str | None) -> DataFrame:
    """The facts of a province and years with their subject and the major's canonical name."""
    here = [r.id for r in provinces.filter(F.col("name") == province).select("id").distinct().collect()]  # as values a filter goes down to the tables
    out = facts.filter(F.col("year").isin(years) & F.col("province_id").isin(here)).join(_named(subjects, "subject_category_id", "subject_category"), "subject_category_id", "left")
    return out.filter(_of_subject(subject)).join(_named(majors, "major_id", "canonical_major_name"), "major_id", "left")


def export_plans(plans: DataFrame, provinces: DataFrame, schools: DataFrame, subjects: DataFrame, majors: DataFrame, subcategories: DataFrame, categories: DataFrame, school_majors: DataFrame, province: str, year: int, subject: str | None = None) -> DataFrame:
    """A year's plans of a province with all that the export says of their school and major."""
    own = cut(_facts(plans, provinces, subjects, majors, province, [year], subject))
    sub = subcategories.select(F.col("id").alias("subcategory_id"), F.col("name").alias("major_subcategory"), F.col("category_id").alias("_of"))
    kinds = majors.select(F.col("id").alias("major_id"), "education_level", "subcategory_id", "category_id").join(sub, "subcategory_id", "left")
    kinds = kinds.withColumn("_cat", F.coalesce("_of", "category_id")).join(_named(categories, "_cat", "major_category"), "_cat", "left")
    held = ["city", "authority", "school_type", "is_211", "is_985", "is_double_first", "is_private", "is_independent", "is_sino_foreign"]
    at = schools.select(F.col("id").alias("school_id"), "sch_id", F.col("name").alias("school_name"), F.col("crawl_task_id").alias("school_crawl_task_id"), F.col("level").alias("school_level"), F.col("province_id").alias("_home"), *held)
    at = at.join(_named(provinces, "_home", "school_province"), "_home", "left").drop("_home")
    strong = school_majors.join(own.select("school_id").distinct(), "school_id", "left_semi").select("school_id", "major_id", "major_strength_tier", "strength_evidence")
    out = own.join(at, "school_id").join(kinds.select("major_id", "education_level", "major_category", "major_subcategory"), "major_id", "left")
    return out.join(strong, ["school_id", "major_id"], "left").withColumnRenamed("id", "plan_id").withColumnRenamed("major_name", "major_full_name")


def export_admissions(results: DataFrame, provinces: DataFrame, subjects: DataFrame, majors: DataFrame, province: str, years: list[int], subject: str | None = None) -> DataFrame:
    return _facts(results, provinces, subjects, majors, province, years, subject).withColumnRenamed("id", "admission_id")


def export_past_plans(plans: DataFrame, provinces: DataFrame, subjects: DataFrame, majors: DataFrame, province: str, years: list[int], subject: str | None = None) -> DataFrame:
    return _facts(plans, provinces, subjects, majors, province, years, subject).withColumnRenamed("id", "historical_plan_id")


def latest_charters(charters: DataFrame, plans: DataFrame, provinces: DataFrame, province: str, year: int) -> DataFrame:
    """For each school that has a plan of the year in the province its last charter up to the year."""
    here = provinces.filter(F.col("name") == province).select(F.col("id").alias("province_id"))
    wanted = plans.filter(F.col("year") == year).join(here, "province_id", "left_semi").select("school_id").distinct()
    return pick(charters.filter(F.col("year") <= year).join(wanted, "school_id", "left_semi"), ["school_id"], [F.col("year"), F.col("id")], ["year", "content", "source_url"])


def _matched_by(rows: DataFrame, ident: str, full: str, keep: list[str]) -> DataFrame:
    """Plans or facts as match_history reads them."""
    blank = lambda c: text.clean_text(F.col(c)) == "" if c in rows.columns else F.lit(True)
    none = F.lit(None).cast("string")
    given = ~(blank("batch_code") & blank("batch_category") & blank("batch_segment"))
    read = classify.batch(text.clean_text("batch"))
    part = lambda c, k: F.when(given, F.col(c) if c in rows.columns else none).otherwise(read[k])
    own = lambda c: F.col(c) if c in rows.columns else none
    return rows.select(
        F.col(ident).cast("string").alias(ident), *keep, "school_id", "major_id", text.subject_label(F.coalesce("subject_category", F.lit(""))).alias("subject"), F.col(full).alias("full_name"),
        F.nullif(F.col("canonical_major_name"), F.lit("")).alias("canonical_name"), own("school_code_raw").alias("school_code"), own("major_group_code").alias("group_code"), own("major_code_raw").alias("major_code"),
        part("batch_code", "code").alias("batch_code"), part("batch_segment", "segment").alias("batch_segment"), text.batch_text("batch").alias("batch_text"),
    )


def _by_year(matches: DataFrame, years: list[int], values: list[str], out: str) -> DataFrame:
    """One row a plan: for each year, at its place in an array, the values of its match."""
    held = F.struct(*values)
    return matches.groupBy("plan_id").agg(F.array(*[F.max(F.when(F.col("year") == y, held)) for y in years]).alias(out))


def export_rows(plans: DataFrame, admissions: DataFrame, past_plans: DataFrame, charters: DataFrame, year: int, province: str) -> DataFrame:
    """The rows as cells c0 to c64, with plan_id, is_new and the four years' `matched` flags; without order.

    c0 to c19 are the plan's, then come five cells for each of the four years before it (admitted, lowest score and rank, batch,
    planned: from the admission that matches, the number planned else from the plan that matches), then the school's 25.
    """
    years = [year - k for k in range(1, 5)]
    plans, admissions, past_plans = cut(plans), cut(admissions), cut(past_plans)  # each is read several times
    asked = cut(_matched_by(plans, "plan_id", "major_full_name", []))
    null = F.lit(None).cast("bigint")
    facts = ["year", F.when(F.col("data_source") == OFFICIAL, 1).otherwise(0).alias("official"), "min_rank", "min_score", "admitted_count", "plan_count"]
    past = cut(_matched_by(admissions, "admission_id", "major_name_raw", facts).withColumnRenamed("admission_id", "history_id"))
    older = ["year", F.lit(0).alias("official"), null.alias("min_rank"), null.alias("min_score"), null.alias("admitted_count"), "plan_count"]
    old = cut(_matched_by(past_plans, "historical_plan_id", "major_name", older).withColumnRenamed("historical_plan_id", "history_id"))
    results = admissions.select(F.col("admission_id").cast("string").alias("history_id"), "admitted_count", "min_score", "min_rank", "batch", "plan_count")
    planned = past_plans.select(F.col("historical_plan_id").cast("string").alias("history_id"), "plan_count")
    by_result = _by_year(match_history(asked, past, years).join(results, "history_id"), years, ["admitted_count", "min_score", "min_rank", "batch", "plan_count", "history_id"], "_results")
    by_plan = _by_year(match_history(asked, old, years).join(planned, "history_id"), years, ["plan_count", "history_id"], "_plans")
    p = plans.withColumn("plan_id", F.col("plan_id").cast("string")).join(by_result, "plan_id", "left").join(by_plan, "plan_id", "left")
    p = p.join(charters.select("school_id", F.col("content").alias("_content"), F.col("source_url").alias("_charter")), "school_id", "left")
    at = lambda column, k: F.get(F.col(column), F.lit(k))
    found = [F.coalesce(at("_results", k)["history_id"].isNotNull(), F.lit(False)) for k in range(4)]
    other = [F.coalesce(at("_plans", k)["history_id"].isNotNull(), F.lit(False)) for k in range(4)]
    is_new = ~reduce(lambda a, b: a | b, found + other)
    canonical = F.coalesce(text.as_text("canonical_major_name"), F.nullif(text.base_major("major_full_name"), F.lit("")))
    full = F.coalesce(text.as_text("major_full_name"), canonical)
    nothing = F.lit(None).cast("string")
    col = F.col
    cells: list[Column] = [
        col("plan_id"), F.lit(year), F.lit(province), col("batch"), text.subject_label(F.coalesce("subject_category", F.lit(""))), text.plan_category("program_type"), text.as_text("school_code_raw"), col("school_name"), text.as_text("major_code_raw"), full,
        canonical, text.major_note(full, canonical, "note"), text.selection_requirement("selection_requirement"), text.education_level("education_level", "batch"), col("plan_count"), text.duration("duration"), col("tuition"), col("major_category"), col("major_subcategory"), F.when(is_new, "新增"),
    ]
    for k in range(4):
        r = at("_results", k)
        cells += [r["admitted_count"], r["min_score"], r["min_rank"], r["batch"], F.coalesce(r["plan_count"], at("_plans", k)["plan_count"])]
    url = F.coalesce(F.nullif(col("_charter"), F.lit("")), F.concat(F.lit(CHARTERS), col("sch_id").cast("string"), F.lit(".dhtml")))
    block = dict.fromkeys(range(SCHOOL), nothing) | {
        0: col("school_province"), 1: col("city"), 3: text.tags(col("is_985"), col("is_211"), col("is_double_first")), 6: col("authority"), 7: col("school_type"),
        8: text.ownership(col("is_sino_foreign"), col("is_private"), col("is_independent"), col("school_crawl_task_id")), 9: col("school_level"),
        17: text.admission_rule("_content", "adjustment_rule"), 18: url, 22: text.strength_label(F.from_json("strength_evidence", "array<struct<signal_type: string, signal_level: string>>"), col("major_strength_tier")),
    }
    cells += [block[k] for k in range(SCHOOL)]
    if len(cells) != BASE + 4 * PAST + SCHOOL:
        raise ValueError("a row has another number of cells")
    return p.select(*[c.alias(f"c{i}") for i, c in enumerate(cells)], "plan_id", is_new.alias("is_new"), F.array(*found).alias("matched"))


def in_export_order(plans: DataFrame) -> list[Column]:
    """By subject (physics, history, others), school and codes; over the columns of export_plans."""
    label = F.replace(F.coalesce("subject_category", F.lit("")), F.lit("类"), F.lit(""))
    return [F.when(label == "物理", 0).when(label == "历史", 1).otherwise(2), F.col("school_name").asc(), *[F.col(c).asc_nulls_last() for c in ("school_code_raw", "major_group_code", "major_code_raw", "plan_id")]]
