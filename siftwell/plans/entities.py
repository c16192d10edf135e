"""The stored tables: natural keys, whether nulls of a key match (T1), and what a valid row is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.hashing import validate
from siftwell.operators import merge
from siftwell.operators.merge import EntitySpec

STRENGTH = ("school_major_display_order", "major_strength_rank", "major_strength_score", "major_strength_tier", "is_featured_major", "strength_evidence")


def _spec(table: str, keys: str, null_safe: bool = True, **more) -> EntitySpec:
    return EntitySpec(table, tuple(keys.split()), null_safe, **more)


#: Entity, its table and key.
ENTITIES = {
    "schools": _spec("schools", "sch_id", preserve=("province_id",)),
    "school_satisfaction": _spec("school_satisfaction", "school_id year", False),
    "major_categories": _spec("major_categories", "name education_level", False),
    "major_subcategories": _spec("major_subcategories", "category_id name", False),
    "majors": _spec("majors", "code education_level", False),
    "school_majors": _spec("school_majors", "school_id major_id", False),
    "school_major_strength_signals": _spec("school_major_strength_signals", "school_id major_id signal_type signal_level evidence_year"),
    "major_satisfaction": _spec("major_satisfaction", "major_id school_id", False),
    "interpretations": _spec("major_interpretations", "major_id title"),
    "score_lines": _spec("admission_score_lines", "province_id year subject_category_id batch special_name"),
    "score_segments": _spec("score_segments", "province_id year subject_category_id score"),
    "enrollment_plans": _spec("enrollment_plans", "school_id province_id year subject_category_id batch school_code_raw major_group_code major_code_raw major_name"),
    "major_admission_results": _spec("major_admission_results", "school_id major_id province_id year subject_category_id batch school_code_raw major_group_code major_code_raw major_name_raw"),
    "charters": _spec("admission_charters", "school_id year", False),
    "timelines": _spec("volunteer_timelines", "province_id year batch", False),
    "special": _spec("special_enrollments", "enrollment_type school_id school_code_raw year title source_section detail_url"),
    "announcements": _spec("provincial_announcements", "province_id title source_url"),
    "source_documents": _spec("source_documents", "data_source_id source_url content_hash", False),
    "entity_evidence": _spec("entity_evidence", "entity_type entity_id source_document_id field_name extracted_value_hash"),
}
#: These have no hash column: they are upserted as they are (T12).
PLAIN = {"major_categories", "major_subcategories"}


def constraints(df: DataFrame) -> dict[str, Column]:
    """C-14: the constraints on columns that df has; null passes but where a value is needed."""
    between = {"year": (2000, 2100), "overall_score": (0, 5), "environment_score": (0, 5), "life_score": (0, 5), "confidence": (0, 1), "authority_level": (0, 100)}
    out = {c: F.coalesce(F.col(c).between(*b), F.lit(True)) for c, b in between.items() if c in df.columns}
    if "code" in df.columns:
        out["code"] = F.coalesce(F.trim("code") != "", F.lit(False))
    return out


def apply(entity: str, current: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(table after, snapshot rows, rejects with the names of what is wrong). An unknown entity is all rejects (L-4)."""
    if entity not in ENTITIES:
        return current, None, incoming.withColumn("errors", F.array(F.lit("entity")))
    good, bad = validate(incoming, constraints(incoming))
    spec = ENTITIES[entity]
    if entity in PLAIN:
        return merge.upsert(current, good, spec), None, bad
    table, log = merge.apply_changes(current, good, spec, entity)
    return table, log, bad
