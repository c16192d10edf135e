"""Queries of the audits over stored tables and of the candidate chain in full, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.plans import audits, candidates
from siftwell.plans.adapters import ADM
from siftwell.plans.export_queries import PLACE, YEAR, answers_sql, stored
from siftwell.plans.readiness import FLAGS
from siftwell.plans.registry import query

YEARS = [YEAR - 2, YEAR - 1]
_SPAN = [1998, 1999, 2000, 2031]  # of the last there are no facts

#: Facts of a province as `stored` has them: res(ults) and pl(ans).
_FACTS = f"""WITH {ADM}, f AS (SELECT adm.*, p_name AS nm FROM adm JOIN part ON p_partkey = major_id WHERE province = {{province}} AND {{scope}}),
res AS (SELECT yr, school_id, major_id, nm, min_score, min_rank, CASE WHEN plan_count > 25 THEN plan_count END AS pc FROM f),
pl AS (SELECT yr, school_id, CASE WHEN k1 % 10 <> 0 THEN major_id END AS mid, nm, CASE WHEN plan_count > 3 THEN plan_count END AS pc, CASE WHEN k1 % 3 <> 0 THEN batch END AS grp FROM f)
"""


@query(_FACTS.format(province=3, scope="true") + f""", y AS (SELECT CAST(unnest({_SPAN}) AS BIGINT) AS yr),
a AS (SELECT yr, count(DISTINCT school_id) AS s, count(*) AS n, count(pc) AS c, count(DISTINCT major_id) AS m FROM res GROUP BY yr),
p AS (SELECT yr, count(DISTINCT school_id) AS s, count(*) AS n, count(pc) AS c, count(grp) AS g, count(DISTINCT mid) AS m, CAST(sum(pc) AS BIGINT) AS total FROM pl GROUP BY yr)
SELECT 'P3' AS province_code, 'NATION_3' AS province_name, yr AS "year", coalesce(a.s, 0) AS admission_schools, coalesce(a.n, 0) AS admission_records, coalesce(a.c, 0) AS admission_records_with_plan_count, CAST(0 AS BIGINT) AS admission_records_with_major_group_code,
  coalesce(a.m, 0) AS admission_majors, coalesce(p.s, 0) AS plan_schools, coalesce(p.n, 0) AS plan_records, coalesce(p.c, 0) AS plan_records_with_plan_count, coalesce(p.g, 0) AS plan_records_with_major_group_code, coalesce(p.n, 0) AS plan_records_with_selection_requirement,
  coalesce(p.m, 0) AS plan_majors, coalesce(p.total, 0) AS plan_count_sum, greatest(coalesce(a.s, 0) - coalesce(p.s, 0), 0) AS missing_plan_schools FROM y LEFT JOIN a USING (yr) LEFT JOIN p USING (yr)""")
def audit_year_coverage(s, d):
    return audits.year_coverage(stored(s, d), "P3", _SPAN)


@query(f"""WITH {ADM}, a AS (SELECT school_id, yr, count(*) AS n, count(*) FILTER (plan_count > 25) AS c, count(DISTINCT major_id) AS m FROM adm WHERE province = 3 AND yr IN (1998, 1999, 2000) GROUP BY ALL)
SELECT 'P3' AS province_code, 'NATION_3' AS province_name, yr AS "year", school_id, s_name AS school_name, n AS admission_records, c AS admission_records_with_plan_count, CAST(0 AS BIGINT) AS admission_records_with_major_group_code, m AS admission_majors,
  {", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in ("plan_records", "plan_records_with_plan_count", "plan_records_with_major_group_code", "plan_records_with_selection_requirement", "plan_majors", "plan_count_sum"))}
FROM a JOIN supplier ON s_suppkey = school_id WHERE NOT EXISTS (SELECT 1 FROM adm x WHERE (x.school_id + x.yr) % 3 = 0 AND x.province = 3 AND x.school_id = a.school_id AND x.yr = a.yr) ORDER BY yr DESC, n DESC, s_name, school_id LIMIT 50""")
def audit_plan_gaps(s, d):
    """Here a school has plans every third year, so that there are gaps."""
    x = stored(s, d)
    return audits.plan_gaps(x | {"enrollment_plans": x["enrollment_plans"].filter("(school_id + year) % 3 = 0")}, PLACE, [1998, 1999, 2000])


_SCOPED = answers_sql("subject = 'A' AND (batch = 'F' OR origin = 'F')", 7)


def _of_readiness(what: str, tail: str = "") -> str:
    return f"SELECT {what} FROM ({_SCOPED}) r {tail}"


@query(_of_readiness("school_name, major_name, enrollment_plan_id, admission_match_type, flags", "WHERE flags <> '' ORDER BY len(string_split(flags, ',')) DESC, school_name, major_name, enrollment_plan_id LIMIT 50"))
def audit_readiness_gaps(s, d):
    gaps = audits.readiness_gaps(audits.readiness(stored(s, d), "P7", YEAR, YEARS, "A", "F"))
    return gaps.select("school_name", "major_name", "enrollment_plan_id", "admission_match_type", F.array_join("readiness_flags", ",").alias("flags"))


@query(_of_readiness("count(*) AS plan_major_count, count(*) FILTER (flags = '') AS answer_ready_count, count(*) FILTER (flags <> '') AS gap_count, " + ", ".join(f"count(*) FILTER (list_contains(string_split(flags, ','), '{f}')) AS {f}" for f in FLAGS)))
def audit_readiness_summary(s, d):
    return audits.readiness_summary(audits.readiness(stored(s, d), "P7", YEAR, YEARS, "A", "F"))


def _met(kind: str, where: str) -> str:
    return ", ".join(f"count(*) FILTER ({where}{test}) AS {kind}{suffix}_count" for suffix, test in (("", ""), ("_with_min_score", f" AND {kind[0]}s"), ("_with_min_rank", f" AND {kind[0]}r")))


@query(_FACTS.format(province=7, scope="subject = 'A' AND (batch = 'F' OR origin = 'F')") + f""", o AS (SELECT DISTINCT school_id, mid, nm FROM pl WHERE yr = {YEAR}), h AS (SELECT * FROM res WHERE yr IN ({YEARS[0]}, {YEARS[1]})),
j AS (SELECT o.*, (SELECT bool_or(min_score IS NOT NULL) FROM h WHERE h.school_id = o.school_id AND h.major_id = o.mid) AS es, (SELECT bool_or(min_rank IS NOT NULL) FROM h WHERE h.school_id = o.school_id AND h.major_id = o.mid) AS er,
  (SELECT bool_or(min_score IS NOT NULL) FROM h WHERE h.school_id = o.school_id AND h.nm = o.nm) AS ns, (SELECT bool_or(min_rank IS NOT NULL) FROM h WHERE h.school_id = o.school_id AND h.nm = o.nm) AS nr FROM o)
SELECT count(*) AS plan_major_count, count(mid) AS plan_major_with_major_id_count, {_met("exact_major_id_match", "es IS NOT NULL")}, {_met("normalized_name_match", "ns IS NOT NULL")}, {_met("normalized_name_only_match", "es IS NULL AND ns IS NOT NULL")},
  count(*) FILTER (es IS NULL AND ns IS NULL) AS unmatched_plan_major_count FROM j""")
def audit_match_diagnostics(s, d):
    return audits.match_diagnostics(stored(s, d), "P7", YEAR, YEARS, "A", "F")


@query(_FACTS.format(province=3, scope="true") + f""", o AS (SELECT DISTINCT school_id, mid, nm FROM pl WHERE yr = {YEAR}),
st AS (SELECT l_suppkey, l_partkey, bool_or(l_returnflag = 'R') AS sig, max(l_quantity) > 49 OR min(l_quantity) < 2 OR max(l_quantity) = 42 OR l_partkey % 4 = 1 AS up FROM lineitem GROUP BY l_suppkey, l_partkey)
SELECT count(*) AS plan_major_count, count(l_partkey) AS plan_major_with_school_major_count, count(*) FILTER (sig) AS plan_major_with_strength_signal_count, count(*) FILTER (up) AS plan_major_with_strength_rollup_count, count(*) FILTER (sig AND NOT up) AS plan_major_signal_without_rollup_count
FROM o LEFT JOIN st ON l_suppkey = school_id AND l_partkey = mid""")
def audit_strength_diagnostics(s, d):
    return audits.strength_diagnostics(stored(s, d), PLACE, YEAR)


# ---- the candidate chain in full -----------------------------------------------------------------------------------

_BATCH, _RANK, _WINDOW = "本科批", 2000, 1500
#: Of each attribute: in plans by k1 and k2, in admissions another way.
_TEXTS = ["selection_requirement", "physical_exam_limit", "single_subject_limit", "adjustment_rule", "tuition", "education_location"]
_BOTH = ["program_type", "eligibility_requirements", "physical_exam_or_political_review", "political_review_requirement", "service_obligation"]


def _batches(df: DataFrame) -> DataFrame:
    """A fourth has the batch as written, a fourth its code, category and segment, or another segment."""
    of = F.col("k1") % 4
    regular = F.when(of == 1, "regular")
    return df.withColumns({"batch": F.when(of == 0, _BATCH).when(of == 1, "普通类本科批").otherwise(F.col("batch")), "batch_code": regular, "batch_category": F.when(of == 1, "普通批"), "batch_segment": F.when((of == 1) & (F.col("k2") % 2 == 0), "A段").when(of != 1, "B段")})


def _attributes(df: DataFrame, names: list[str], n: int) -> DataFrame:
    return df.withColumns({c: F.when((F.col("k1") + F.col("k2")) % (n + i) != 0, F.concat(F.lit(f"{c[:2]}{i}-"), (F.col("k2") + i).cast("string"))) for i, c in enumerate(names)})


def _attributes_sql(names: list[str], n: int) -> str:
    return ", ".join(f"CASE WHEN (k1 + k2) % {n + i} <> 0 THEN '{c[:2]}{i}-' || (k2 + {i}) END AS {c}" for i, c in enumerate(names))


_CODES_SQL = "CASE WHEN k2 % 3 <> 0 THEN 'g' || k2 END AS major_group_code, 'c' || (k1 % 97) AS major_code_raw, CASE WHEN k1 % 2 = 0 THEN 'campus' || (k2 % 2) END AS campus"
_BATCH_SQL = f"CASE k1 % 4 WHEN 0 THEN '{_BATCH}' WHEN 1 THEN '普通类本科批' ELSE batch END AS batch, CASE WHEN k1 % 4 = 1 THEN 'regular' END AS batch_code, CASE WHEN k1 % 4 = 1 THEN '普通批' END AS batch_category, CASE WHEN k1 % 4 = 1 THEN CASE WHEN k2 % 2 = 0 THEN 'A段' END ELSE 'B段' END AS batch_segment"
_OK = f"(batch = '{_BATCH}' OR (batch_code = 'regular' AND batch_category = '普通批' AND batch_segment IS NULL))"
_LEAST_SQL = ", ".join(f"min({c}) AS {c}" for c in candidates.LEAST)
_GREATEST_SQL = ", ".join(f"max({c}) AS {c}" for c in candidates.GREATEST)


def _listed_sql(names: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in names) + ")"


def _listed(column: str, names: list[str]):
    return F.array_join(F.array_sort(F.transform(F.col(column), lambda x: F.concat_ws("|", *[F.coalesce(x[c].cast("string"), F.lit("-")) for c in names]))), ";")


@query(f"""WITH {ADM}, b AS (SELECT * EXCLUDE (batch), yr AS "year", p_name AS major_name, {_BATCH_SQL}, {_CODES_SQL} FROM adm JOIN part ON p_partkey = major_id WHERE province = 3 AND subject = 'A'),
r AS (SELECT * EXCLUDE (plan_count), CASE WHEN plan_count > 25 THEN plan_count END AS plan_count, min_rank % 7 AS admitted_count, 's' || (k1 % 11) AS school_code_raw, {_attributes_sql(_BOTH, 3)} FROM b WHERE yr BETWEEN 1997 AND 1999 AND {_OK}),
p AS (SELECT * EXCLUDE (plan_count), CASE WHEN plan_count > 3 THEN plan_count END AS plan_count, CASE WHEN k1 % 5 <> 0 THEN major_id END AS plan_major, {_attributes_sql(_BOTH, 2)}, {_attributes_sql(_TEXTS, 2)} FROM b WHERE yr = 2000),
m AS (SELECT DISTINCT school_id, major_id, major_name FROM r WHERE min_rank BETWEEN {_RANK - _WINDOW} AND {_RANK + _WINDOW}),
one AS (SELECT school_id, major_name, min(major_id) AS major_id FROM m GROUP BY ALL HAVING count(*) = 1),
q AS (SELECT p.* EXCLUDE (major_id), plan_major AS major_id FROM p WHERE {_OK} AND EXISTS (SELECT 1 FROM m WHERE m.school_id = p.school_id AND m.major_id = p.plan_major)
  UNION ALL SELECT p.* EXCLUDE (major_id), one.major_id FROM p JOIN one USING (school_id, major_name) WHERE {_OK} AND plan_major IS NULL
  AND NOT EXISTS (SELECT 1 FROM p z WHERE z.plan_major IS NOT NULL AND z.school_id = p.school_id AND z.batch = p.batch AND z.major_name = p.major_name)),
c AS (SELECT school_id, major_id, CAST(sum(plan_count) AS BIGINT) AS current_plan_count, string_agg({_listed_sql(candidates.OPTION)}, ';' ORDER BY {_listed_sql(candidates.OPTION)}) AS options, {_LEAST_SQL}, {_GREATEST_SQL}, {", ".join(f"max({x}) AS {x}" for x in _TEXTS)} FROM q GROUP BY ALL),
h AS (SELECT school_id, major_id, max(school_code_raw) AS school_code_raw, max(plan_count) AS historical_plan_count, string_agg({_listed_sql(candidates.PAST)}, ';' ORDER BY {_listed_sql(candidates.PAST)}) AS history, min(abs(min_rank - {_RANK})) AS rank_distance, {_LEAST_SQL}, {_GREATEST_SQL} FROM r GROUP BY ALL),
st AS (SELECT l_suppkey AS school_id, l_partkey AS major_id, max(l_quantity) > 49 AS f, CASE WHEN min(l_quantity) < 2 THEN 1 END AS k FROM lineitem GROUP BY ALL)
SELECT m.school_id, m.major_id, m.major_name, 'M' || m.major_id AS major_code, s_name AS school_name, 'city' AS school_city, h.school_code_raw, historical_plan_count, history, rank_distance, current_plan_count, options, coalesce(f, false) AS is_featured_major, CAST(k AS INT) AS major_strength_rank,
  {", ".join(f"coalesce(c.{x}, h.{x}) AS {x}" for x in (*candidates.LEAST, *candidates.GREATEST))}, {", ".join(f"c.{x}" for x in _TEXTS)}
FROM m JOIN supplier ON s_suppkey = school_id LEFT JOIN h USING (school_id, major_id) LEFT JOIN c USING (school_id, major_id) LEFT JOIN st USING (school_id, major_id)""")
def admission_chain(s, d):
    """Lists are compared as their items' texts, sorted."""
    x = stored(s, d)
    codes = {"major_group_code": F.when(F.col("k2") % 3 != 0, F.concat(F.lit("g"), "k2")), "major_code_raw": F.concat(F.lit("c"), (F.col("k1") % 97).cast("string")), "campus": F.when(F.col("k1") % 2 == 0, F.concat(F.lit("campus"), (F.col("k2") % 2).cast("string")))}
    results = _attributes(_batches(x["major_admission_results"]).withColumns(codes), _BOTH, 3).withColumn("school_code_raw", F.concat(F.lit("s"), (F.col("k1") % 11).cast("string")))
    plans = _attributes(_attributes(_batches(x["enrollment_plans"]).withColumns(codes), _BOTH, 2), _TEXTS, 2).withColumn("major_id", F.when(F.col("k1") % 5 != 0, F.col("major_id")))
    majors = x["majors"].withColumn("code", F.concat(F.lit("M"), F.col("id").cast("string")))
    taught = x["school_majors"].withColumns({"school_major_display_order": F.lit(None).cast("int"), "major_strength_tier": F.lit(None).cast("string")})
    out = candidates.admission_chain(results, plans, x["schools"], majors, taught, 3, YEAR, "A", _BATCH, _RANK, _WINDOW)
    shown = ["school_id", "major_id", "major_name", "major_code", "school_name", "school_city", "school_code_raw", "historical_plan_count", "rank_distance", "current_plan_count", "is_featured_major", "major_strength_rank", *candidates.LEAST, *candidates.GREATEST, *_TEXTS]
    return out.select(*shown, _listed("current_plan_options", candidates.OPTION).alias("options"), _listed("admission_history", candidates.PAST).alias("history"))
