"""Queries of the wide export; in these tables names and batches tell all, so that SQL can choose a year's row by one order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.plans import answer_readiness, exports
from siftwell.plans.adapters import ADM, adm, t
from siftwell.plans.registry import query

YEAR, PLACE = 2000, "NATION_3"
_ID = "concat_ws('-', k1, k2, major_id, school_id, coalesce(min_score, -1))"
_NONE = ["batch_code", "batch_category", "batch_segment", "school_code_raw", "major_group_code", "major_code_raw"]


def _tables(s, d) -> dict[str, DataFrame]:
    names = t(s, d, "part").select(F.col("p_partkey").alias("major_id"), F.col("p_name").alias("major_name"))
    facts = adm(s, d).join(names, "major_id").withColumns({c: F.lit(None).cast("string") for c in _NONE})
    facts = facts.select(F.expr(_ID).alias("id"), F.col("yr").alias("year"), F.col("province").alias("province_id"), F.col("subject").alias("subject_category_id"), "*").drop("yr", "province", "subject")
    plans = facts.withColumn("major_id", F.when(F.col("k1") % 10 != 0, F.col("major_id")))
    plans = plans.withColumns({"program_type": F.when(F.col("k2") == 1, "国家专项"), "duration": F.lit("四年"), "tuition": F.lit("5000"), "note": F.col("origin"), "selection_requirement": F.lit("物理+ 化学"), "adjustment_rule": F.col("origin")})
    results = facts.withColumns({"admitted_count": F.col("min_rank") % 7, "plan_count": F.when(F.col("plan_count") > 25, F.col("plan_count")), "major_name_raw": F.col("major_name"), "data_source": F.when(F.col("origin") == "F", exports.OFFICIAL).otherwise("other")})
    sup = t(s, d, "supplier")
    schools = sup.select(
        F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("sch_id"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 2 == 0, 1).alias("crawl_task_id"), F.lit("本科").alias("level"), F.col("s_nationkey").cast("bigint").alias("province_id"),
        F.lit("city").alias("city"), F.lit("部").alias("authority"), F.lit("综合").alias("school_type"), *[(F.col("s_suppkey") % k == 0).alias(c) for k, c in ((3, "is_211"), (5, "is_985"), (7, "is_double_first"), (4, "is_private"), (13, "is_independent"), (11, "is_sino_foreign"))],
    )
    part = t(s, d, "part")
    return {
        "plans": plans, "results": results, "schools": schools, "provinces": t(s, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name")),
        "subjects": s.createDataFrame([("A", "物理类"), ("R", "历史类")], "id string, name string"),
        "majors": part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.lit("本科").alias("education_level"), F.col("p_size").cast("bigint").alias("subcategory_id"), F.lit(None).cast("bigint").alias("category_id")),
        "subcategories": part.select(F.col("p_size").cast("bigint").alias("id"), F.concat(F.lit("sub"), "p_size").alias("name"), (F.col("p_size") % 25).cast("bigint").alias("category_id")).distinct(),
        "categories": t(s, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name")),
        "school_majors": t(s, d, "lineitem").select(F.col("l_suppkey").alias("school_id"), F.col("l_partkey").alias("major_id")).distinct().withColumns({"major_strength_tier": F.when(F.col("major_id") % 3 == 0, "national"), "strength_evidence": F.when(F.col("major_id") % 2 == 0, '[{"signal_type": "featured_major", "signal_level": "national"}]')}),
        "charters": t(s, d, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 100 + 1).alias("school_id"), F.year("o_orderdate").cast("bigint").alias("year"), F.when(F.col("o_orderkey") % 2 == 0, "实行分数优先").otherwise("").alias("content"), F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("u"), "o_orderkey")).alias("source_url")),
    }


def _exported(s, d) -> DataFrame:
    x = _tables(s, d)
    years = [YEAR - k for k in range(1, 5)]
    common = (x["provinces"], x["subjects"], x["majors"], PLACE)
    plans = exports.export_plans(x["plans"], x["provinces"], x["schools"], x["subjects"], x["majors"], x["subcategories"], x["categories"], x["school_majors"], PLACE, YEAR)
    return exports.export_rows(plans, exports.export_admissions(x["results"], *common, years), exports.export_past_plans(x["plans"], *common, years), exports.latest_charters(x["charters"], x["plans"], x["provinces"], PLACE, YEAR), YEAR, PLACE)


def _past(k: int) -> str:
    return f"r{k}.admitted AS c{20 + 5 * k}, r{k}.min_score AS c{21 + 5 * k}, r{k}.min_rank AS c{22 + 5 * k}, r{k}.batch AS c{23 + 5 * k}, coalesce(r{k}.pc, q{k}.plan_count) AS c{24 + 5 * k}"


_EXPORT = f"""WITH {ADM}, f AS (SELECT {_ID} AS id, adm.*, p_name AS nm, p_size FROM adm JOIN part ON p_partkey = major_id JOIN nation ON n_nationkey = province WHERE n_name = '{PLACE}'),
pl AS (SELECT *, CASE WHEN k1 % 10 <> 0 THEN major_id END AS mid FROM f WHERE yr = {YEAR}),
c AS (SELECT pl.id AS plan_id, pl.mid, pl.batch AS own, h.id, h.yr, h.major_id AS hid, CASE WHEN h.k1 % 10 <> 0 THEN h.major_id END AS pid, h.batch, h.min_score, h.min_rank, h.min_rank % 7 AS admitted, CASE WHEN h.plan_count > 25 THEN h.plan_count END AS pc, h.plan_count, h.origin
  FROM pl JOIN f h ON h.school_id = pl.school_id AND h.subject IS NOT DISTINCT FROM pl.subject AND h.nm = pl.nm AND h.yr BETWEEN {YEAR - 4} AND {YEAR - 1}),
n AS (SELECT plan_id, yr, count(DISTINCT hid) AS hids, count(DISTINCT pid) AS pids FROM c GROUP BY ALL),
r AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY plan_id, yr ORDER BY (min_rank IS NOT NULL)::INT + (min_score IS NOT NULL)::INT + (admitted IS NOT NULL)::INT + (pc IS NOT NULL)::INT DESC, (origin = 'F') DESC, hid, id) AS rn FROM c JOIN n USING (plan_id, yr) WHERE batch = own AND (mid IS NOT NULL OR hids <= 1)) WHERE rn = 1),
q AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY plan_id, yr ORDER BY pid NULLS LAST, id) AS rn FROM c JOIN n USING (plan_id, yr) WHERE batch = own AND (mid IS NOT NULL OR pids <= 1)) WHERE rn = 1),
ch AS (SELECT school_id, arg_max(struct_pack(o := o_orderkey), year * 1000000000 + o_orderkey).o AS o FROM (SELECT o_orderkey, o_custkey % 100 + 1 AS school_id, year(o_orderdate) AS year FROM orders) WHERE year <= {YEAR} AND school_id IN (SELECT school_id FROM pl) GROUP BY 1)
"""


@query(_EXPORT + f"""SELECT pl.id AS c0, CAST({YEAR} AS INT) AS c1, pl.batch AS c3, CASE pl.subject WHEN 'A' THEN '物理' WHEN 'R' THEN '历史' ELSE '' END AS c4, CASE WHEN k2 = 1 THEN '(国家专项)' END AS c5, s_name AS c7, pl.nm AS c9, pl.nm AS c10, pl.origin AS c11, '化学' AS c12, '四' AS c15_sign,
CASE WHEN pl.mid IS NOT NULL THEN '本科' END AS c13, pl.plan_count AS c14, CASE WHEN pl.mid IS NOT NULL THEN n.n_name END AS c17, CASE WHEN pl.mid IS NOT NULL THEN 'sub' || pl.p_size END AS c18,
CASE WHEN {" AND ".join(f"r{k}.id IS NULL AND q{k}.id IS NULL" for k in range(4))} THEN '新增' END AS c19, {", ".join(map(_past, range(4)))}, h.n_name AS c40, nullif(concat_ws('/', CASE WHEN pl.school_id % 5 = 0 THEN '985' END, CASE WHEN pl.school_id % 3 = 0 THEN '211' END, CASE WHEN pl.school_id % 7 = 0 THEN '双一流' END), '') AS c43,
CASE WHEN pl.school_id % 11 = 0 THEN '中外合作办学' WHEN pl.school_id % 4 = 0 OR pl.school_id % 13 = 0 THEN '民办' WHEN pl.school_id % 2 = 0 THEN '公办' END AS c48, CASE WHEN o % 2 = 0 THEN '分数优先' ELSE pl.origin END AS c57, CASE WHEN o % 3 = 0 THEN 'u' || o ELSE '{exports.CHARTERS}' || pl.school_id || '.dhtml' END AS c58,
CASE WHEN pl.mid % 2 = 0 THEN '国特' WHEN pl.mid % 3 = 0 THEN '国一' END AS c62
FROM pl JOIN supplier ON s_suppkey = pl.school_id LEFT JOIN nation h ON h.n_nationkey = s_nationkey LEFT JOIN nation n ON n.n_nationkey = pl.p_size % 25 LEFT JOIN ch USING (school_id) {" ".join(f"LEFT JOIN r r{k} ON r{k}.plan_id = pl.id AND r{k}.yr = {YEAR - 1 - k} LEFT JOIN q q{k} ON q{k}.plan_id = pl.id AND q{k}.yr = {YEAR - 1 - k}" for k in range(4))}""")
def export_rows(s, d):
    """The cells that these tables fill; c15 is seen by its first sign."""
    out = _exported(s, d)
    some = [0, 1, 3, 4, 5, 7, 9, 10, 11, 12, 13, 14, 17, 18, *range(19, 41), 43, 48, 57, 58, 62]
    return out.select(*[f"c{i}" for i in some], F.when(F.col("c15") == "4", "四").alias("c15_sign"))


def stored(s, d) -> dict[str, DataFrame]:
    """The tables by the names that audits know, with gaps."""
    x = _tables(s, d)
    third = lambda c: F.when(F.col("k1") % 3 != 0, F.col(c))
    plans = x["plans"].withColumns({"major_group_code": third("batch"), "major_code_raw": F.when(F.col("k1") % 5 != 0, F.col("k1").cast("string")), "plan_count": F.when(F.col("plan_count") > 3, F.col("plan_count")), "batch_category": F.col("origin")})
    results = x["results"].withColumns({"max_score": third("min_score"), "avg_score": F.when(F.col("k1") % 5 == 0, F.col("min_score")), "batch_category": F.col("origin")})
    line = t(s, d, "lineitem").select(F.col("l_suppkey").alias("school_id"), F.col("l_partkey").alias("major_id"), "l_quantity", "l_returnflag")
    taught = line.groupBy("school_id", "major_id").agg(F.when(F.max("l_quantity") > 49, True).alias("is_featured_major"), F.when(F.min("l_quantity") < 2, 1).alias("major_strength_rank"), F.when(F.max("l_quantity") == 42, 1).alias("major_strength_score"))
    taught = taught.withColumn("strength_evidence", F.when(F.col("major_id") % 4 == 0, "[]").when(F.col("major_id") % 4 == 1, '["a"]').when(F.col("major_id") % 4 == 2, "[ ]"))
    return {
        "provinces": x["provinces"].withColumn("code", F.concat(F.lit("P"), "id")), "enrollment_plans": plans, "major_admission_results": results, "schools": x["schools"], "majors": x["majors"],
        "school_majors": taught, "school_major_strength_signals": line.filter("l_returnflag = 'R'"),
    }


def _answers(s, d, **asked) -> DataFrame:
    x = stored(s, d)
    return answer_readiness.answer_readiness(x["provinces"], x["enrollment_plans"], x["major_admission_results"], x["schools"], x["majors"], x["school_majors"], x["school_major_strength_signals"], year=YEAR, years=[YEAR - 2, YEAR - 1], **asked)


def answers_sql(scope: str, province: int) -> str:
    """By windows over the facts: each plan's rows by id, else by name."""
    return f"""WITH {ADM}, f AS (SELECT {_ID} AS id, adm.*, p_name AS nm FROM adm JOIN part ON p_partkey = major_id WHERE province = {province} AND {scope}),
pl AS (SELECT *, CASE WHEN k1 % 10 <> 0 THEN major_id END AS mid FROM f WHERE yr = {YEAR}), a AS (SELECT * FROM f WHERE yr IN ({YEAR - 2}, {YEAR - 1})),
w AS (SELECT school_id, 'major_id' AS kind, major_id::VARCHAR AS k, * EXCLUDE (school_id) FROM a UNION ALL SELECT school_id, 'normalized_name', nm, * EXCLUDE (school_id) FROM a),
h AS (SELECT school_id, kind, k, count(DISTINCT CASE WHEN min_score IS NOT NULL THEN yr END) AS ys, count(DISTINCT CASE WHEN min_rank IS NOT NULL THEN yr END) AS yk, max(yr) FILTER (min_score IS NOT NULL) AS sy, max(yr) FILTER (min_rank IS NOT NULL) AS ky,
  arg_max(min_score, yr * 10000000 - min_score) AS sc, arg_max(min_rank, yr * 10000000 - min_rank) AS rk, bool_or(min_score IS NOT NULL AND k1 % 3 <> 0) AS mx, bool_or(min_score IS NOT NULL AND k1 % 5 = 0) AS av, bool_or(min_rank IS NOT NULL) AS ad FROM w GROUP BY ALL),
st AS (SELECT l_suppkey, l_partkey, max(l_quantity) > 49 OR min(l_quantity) < 2 OR max(l_quantity) = 42 OR bool_or(l_returnflag = 'R') AS strong FROM lineitem GROUP BY ALL),
j AS (SELECT pl.*, CASE WHEN e.kind IS NOT NULL THEN e ELSE n END AS x, e.kind IS NOT NULL AS linked, coalesce(strong, false) AS strong FROM pl LEFT JOIN h e ON e.kind = 'major_id' AND e.school_id = pl.school_id AND e.k = pl.mid::VARCHAR
  LEFT JOIN h n ON n.kind = 'normalized_name' AND n.school_id = pl.school_id AND n.k = pl.nm LEFT JOIN st ON l_suppkey = pl.school_id AND l_partkey = pl.mid)
SELECT 'P' || province AS province_code, n_name AS province_name, CAST({YEAR} AS INT) AS plan_year, school_id, s_name AS school_name, id AS enrollment_plan_id, mid AS major_id, nm AS major_name, CASE WHEN plan_count > 3 THEN plan_count END AS plan_count,
  coalesce(CASE WHEN k1 % 3 <> 0 THEN batch END, '') AS group_codes, coalesce(CASE WHEN k1 % 5 <> 0 THEN k1::VARCHAR END, '') AS code_raws, '物理+ 化学' AS requirements, x.kind AS admission_match_type, x.sy AS latest_min_score_year, x.sc AS latest_min_score, x.ky AS latest_min_rank_year, x.rk AS latest_min_rank,
  CAST(coalesce(x.ys, 0) AS INT) AS years_with_min_score, CAST(coalesce(x.yk, 0) AS INT) AS years_with_min_rank, coalesce(x.mx, false) AS has_max_score, coalesce(x.av, false) AS has_avg_score, coalesce(x.ad, false) AS has_admitted_count, strong AS has_strength_evidence,
  concat_ws(',', CASE WHEN plan_count <= 3 THEN 'missing_plan_count' END, CASE WHEN k1 % 3 = 0 THEN 'missing_major_group_code' END, CASE WHEN k1 % 5 = 0 THEN 'missing_major_code_raw' END, CASE WHEN NOT linked THEN 'missing_admission_linkage' END,
    CASE WHEN coalesce(x.ys, 0) < 2 THEN 'missing_admission_min_score' END, CASE WHEN coalesce(x.yk, 0) < 2 THEN 'missing_admission_min_rank' END, CASE WHEN NOT strong THEN 'missing_strength_evidence' END) AS flags
FROM j JOIN supplier ON s_suppkey = school_id JOIN nation ON n_nationkey = province"""


def _flat(out: DataFrame) -> DataFrame:
    lists = {"major_group_codes": "group_codes", "major_code_raws": "code_raws", "selection_requirements": "requirements", "readiness_flags": "flags"}
    return out.select(*[c for c in out.columns if c not in lists], *[F.array_join(c, ",").alias(n) for c, n in lists.items()])


@query(answers_sql("true", 3))
def answer_readiness_all(s, d):
    """A province by its name, all subjects and batches."""
    return _flat(_answers(s, d, province=PLACE))


@query(answers_sql("subject = 'A' AND (batch = 'F' OR origin = 'F')", 7))
def answer_readiness_scoped(s, d):
    """By its code, one subject and one batch category."""
    return _flat(_answers(s, d, province="P7", subject="A", batch="F"))
