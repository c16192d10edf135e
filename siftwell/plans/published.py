"""The published views (M-1 to M-8), as plans over tables that are given; optional columns may be absent and are then null.

Dimensions are joined without hints: their sizes decide at run time whether they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions import text
from siftwell.operators.joins import null_safe_join


def given(df: DataFrame, name: str, kind: str = "string") -> Column:
    """C-1: a column by name, or a typed null."""
    return (df[name] if name in df.columns else F.lit(None)).cast(kind).alias(name)


def _json(df: DataFrame, names: list[str]) -> Column:
    """I-60: an object that keeps its nulls."""
    fields = [F.col(n).alias(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _filled(*names: str) -> list[Column]:
    return [F.nullif(F.col(n), F.lit("")) for n in names]


# ---- documents for retrieval (M-1 to M-3) ---------------------------------------------------------------------------

DOCUMENT = ["document_uid", "document_type", "entity_type", "entity_id", "title", "text", "metadata", "source_url", "source_code", "authority_level", "content_hash", "fetched_at"]
#: The fields of the published objects and rows.
SOURCE_FACTS = ["source_type", "province_code", "source_name", "content_type", "parser_name", "parser_version", "publish_date", "fetched_at"]
SPECIAL_FACTS = [
    "enrollment_type", "special_admission_type", "province_code", "school_code_raw", "school_name_raw", "year", "source_section", "detail_url", "application_url",
    "registration_window", "registration_start", "registration_end", "milestones", "shortlist_rule", "selection_rule", "school_assessment", "school_exam_rule",
    "composite_score_formula", "admission_rule", "eligible_majors", "publish_date", "source_url",
]
SPECIAL_AUTHORITY = 95


def source_documents(documents: DataFrame, sources: DataFrame) -> DataFrame:
    """M-1: documents of a known source. documents: id, data_source_id, title, source_url, content_hash, fetched_at; sources: id, source_code, authority_level."""
    known = sources.select(F.col("id").alias("data_source_id"), "source_code", "authority_level", *[c for c in SOURCE_FACTS if c in sources.columns and c not in documents.columns])
    d = documents.join(known, "data_source_id")
    return d.select(
        F.concat(F.lit("source_document:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("document_uid"), F.lit("source_document").alias("document_type"),
        F.lit(None).cast("string").alias("entity_type"), F.lit(None).cast("bigint").alias("entity_id"), "title", F.coalesce("title", F.lit("")).alias("text"),
        _json(d, SOURCE_FACTS).alias("metadata"), text.strip_query("source_url").alias("source_url"), "source_code", F.col("authority_level").cast("int").alias("authority_level"),
        "content_hash", "fetched_at",
    )


def special_enrollments(df: DataFrame) -> DataFrame:
    """M-2. Title and text are joined by a backslash and an n, two characters (T4)."""
    return df.select(
        F.concat(F.lit("special_enrollment:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("document_uid"), F.lit("special_enrollment").alias("document_type"),
        F.when(F.col("school_id").isNotNull(), "school").alias("entity_type"), F.col("school_id").cast("bigint").alias("entity_id"), "title",
        F.concat_ws("\\n", *_filled("title", "content_text")).alias("text"), _json(df, SPECIAL_FACTS).alias("metadata"),
        text.strip_query(F.coalesce("source_url", F.lit(""))).alias("source_url"),
        F.when(F.col("enrollment_type") == "强基计划", "special_enrollments.strong_foundation").otherwise("special_enrollments").alias("source_code"),
        F.lit(SPECIAL_AUTHORITY).alias("authority_level"), "content_hash", F.coalesce("updated_at", "created_at").alias("fetched_at"),
    )


def vector_documents(documents: DataFrame, sources: DataFrame, special: DataFrame) -> DataFrame:
    """M-3: both kinds, duplicates kept (H-1)."""
    return source_documents(documents, sources).unionByName(special_enrollments(special))


# ---- dimensions (M-4, M-5) ------------------------------------------------------------------------------------------


def schools(df: DataFrame, provinces: DataFrame) -> DataFrame:
    """M-4: ownership and tag arrays; a school without a known province stays (D-2)."""
    named = df.join(provinces.select(F.col("id").alias("province_id"), F.col("name").alias("province")), "province_id", "left")
    joint = F.array_compact(F.array(F.when(F.col("is_sino_foreign"), "中外合作"), F.when(F.col("is_independent"), "独立学院")))
    return named.select(
        F.col("id").alias("school_id"), F.col("name").alias("school_name"), "province", given(named, "city"), given(named, "school_type"),
        text.ownership(F.col("is_sino_foreign"), F.col("is_private"), F.col("is_independent"), F.col("crawl_task_id")).alias("ownership_type"),
        text.tags(F.col("is_985"), F.col("is_211"), F.col("is_double_first"), joined=False).alias("school_tier_tags"), joint.alias("cooperation_tags"),
    )


def majors(df: DataFrame, subcategories: DataFrame, categories: DataFrame) -> DataFrame:
    """M-5: the subcategory's name, else the category's; the subcategory's own category goes first (D-3)."""
    sub = subcategories.select(F.col("id").alias("subcategory_id"), F.col("name").alias("_sub"), F.col("category_id").alias("_above"))
    top = categories.select(F.col("id").alias("_top"), F.col("name").alias("_cat"))
    found = df.join(sub, "subcategory_id", "left").withColumn("_top", F.coalesce("_above", "category_id")).join(top, "_top", "left")
    null = F.lit(None).cast("string")
    return found.select(F.col("id").alias("major_id"), F.col("name").alias("major_name"), F.coalesce("_sub", "_cat").alias("discipline_category"), given(found, "degree").alias("degree_type"), null.alias("tuition_range"), null.alias("subject_restrictions"))


# ---- facts (M-6 to M-8) ---------------------------------------------------------------------------------------------

#: What the notes are joined from, in this order, and which columns pass.
RESULT_NOTES = ["remark", "major_group_code", "major_code_raw", "campus", "program_type", "eligibility_requirements", "physical_exam_or_political_review", "service_obligation"]
PLAN_NOTES = [
    "note", "major_group_code", "major_code_raw", "campus", "education_location", "selection_requirement", "physical_exam_limit", "single_subject_limit", "adjustment_rule",
    "program_type", "eligibility_requirements", "physical_exam_or_political_review", "service_obligation",
]
STRENGTH = {"school_major_display_order": "int", "major_strength_rank": "int", "major_strength_score": "double", "major_strength_tier": "string", "is_featured_major": "boolean", "strength_evidence": "string"}
PASSED = ["campus", "program_type", "eligibility_requirements", "physical_exam_or_political_review", "political_review_requirement", "service_obligation", "selection_requirement", "source_url", "data_source"]


def _with_province(df: DataFrame, provinces: DataFrame, *more: str) -> DataFrame:
    return df.join(provinces.select(F.col("id").alias("province_id"), F.col("code").alias("province_code"), *more), "province_id")


def _records(facts: DataFrame, notes: list[str], evidence: str, hidden: set[str], derived: Column) -> DataFrame:
    shown = lambda name, kind="string": F.lit(None).cast(kind).alias(name) if name in hidden else given(facts, name, kind)
    strength = [given(facts, c, k) if c != "is_featured_major" else F.coalesce(given(facts, c, k), F.lit(False)).alias(c) for c, k in STRENGTH.items()]
    return facts.select(
        "province_code", F.col("year").alias("admission_year"), "school_id", "major_id", F.coalesce(given(facts, "batch_code"), F.col("batch")).alias("batch_code"),
        shown("min_score", "bigint"), shown("min_rank", "bigint"), given(facts, "plan_count", "bigint"),
        F.concat_ws("；", *[given(facts, c) for c in notes]).alias("major_notes"), given(facts, "major_group_code"), given(facts, "major_code_raw"), *strength,
        *[shown(c) for c in PASSED], F.lit(evidence).alias("evidence_source"), shown("min_rank_source"), derived.alias("min_rank_is_derived"),
    )


def admission_records(results: DataFrame, plans: DataFrame, provinces: DataFrame, school_majors: DataFrame) -> DataFrame:
    """M-6: results and plans in one shape, with the major's strength at the school; facts of an unknown province go, duplicates stay."""
    strength = school_majors.select("school_id", "major_id", *[c for c in STRENGTH if c in school_majors.columns])
    r, p = (_with_province(x, provinces).join(strength, ["school_id", "major_id"], "left") for x in (results, plans))
    past = _records(r, RESULT_NOTES, "major_admission_results", {"selection_requirement"}, given(r, "min_rank_is_derived", "boolean"))
    return past.unionByName(_records(p, PLAN_NOTES, "enrollment_plans", {"min_score", "min_rank", "min_rank_source"}, F.lit(False)))


def province_rules(score_lines: DataFrame, plans: DataFrame, segments: DataFrame, provinces: DataFrame) -> DataFrame:
    """M-7: a province's batches; provinces: id, code, name, subject_mode. Subjects are grouped though not shown, so a batch may have several rows; null subjects match each other (D-9)."""
    mode = given(provinces, "subject_mode")
    p = provinces.select("id", "code", F.col("name").alias("province_name"), mode)
    extra, head = ("province_name", "subject_mode"), ["province_code", "province_name", "admission_year", "batch_code", "subject_mode"]
    lines = _with_province(score_lines, p, *extra).select("province_code", "province_name", F.col("year").alias("admission_year"), F.col("batch").alias("batch_code"), "subject_mode", F.lit(None).cast("string").alias("subject_requirements"), F.lit(True).alias("score_rank_available"))
    asked = _with_province(plans, p, *extra).withColumn("admission_year", F.col("year")).withColumn("batch_code", F.coalesce(given(plans, "batch_code"), F.col("batch")))
    asked = asked.groupBy(*head, "province_id", "subject_category_id").agg(F.max("selection_requirement").alias("subject_requirements"))
    known = segments.filter("year IS NOT NULL").select("province_id", F.col("year").alias("admission_year"), "subject_category_id").distinct().withColumn("_hit", F.lit(True))
    asked = null_safe_join(asked, known, ["province_id", "admission_year", "subject_category_id"]).select(*head, "subject_requirements", F.coalesce("_hit", F.lit(False)).alias("score_rank_available"))
    return lines.unionByName(asked).distinct().withColumn("volunteer_mode", F.lit(None).cast("string"))


def score_rank(segments: DataFrame, provinces: DataFrame) -> DataFrame:
    """M-8."""
    return _with_province(segments, provinces).select("province_code", F.col("year").alias("admission_year"), "score", F.col("cumulative_count").alias("rank"))
