"""Audits and the candidate chain on small tables with every case by hand."""

import itertools

from siftwell.functions.text import json_filled
from siftwell.plans import audits, candidates

_NO = [None] * 5


def test_json_filled(spark):
    cases = [("[]", False), ("[ ]", False), (None, False), ("[1]", True), ("{}", True), ("null", True), ("[", False), ("", False), ("[[]]", True)]
    got = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, x string").select("i", json_filled("x").alias("y")).orderBy("i").collect()
    assert [r.y for r in got] == [c[1] for c in cases]


def _tables(spark):
    t = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    fact = "id int, school_id int, major_id int, major_name string, year int, province_id int, subject_category_id int, batch string, batch_category string, plan_count int, major_group_code string"
    return {
        "provinces": t("id int, code string, name string", (1, "21", "辽宁"), (2, "11", "北京")),
        "schools": t("id int, name string", (1, "甲"), (2, "乙"), (3, None)),
        "majors": t("id int, name string", (10, "数学"), (11, "物理学")),
        "enrollment_plans": t(fact + ", major_code_raw string, selection_requirement string",
            (1, 1, 10, "x", 2024, 1, 5, "本科批", None, 3, "g", "c", "s"), (2, 1, None, "物理学专业（师范）", 2024, 1, 5, "本科批", None, None, None, None, None),
            (3, 1, None, "化学", 2024, 1, None, "提前批", "本科批", 2, "g", "c", "s"), (4, 2, 10, "y", 2024, 2, 5, "本科批", None, 2, "g", "c", "s"), (5, 1, 10, "again", 2024, 1, 5, "本科批", None, 9, "g", "c", "s")),
        "major_admission_results": t(fact + ", major_name_raw string, min_score int, min_rank int, max_score int, avg_score double, admitted_count int",
            (1, 1, 10, None, 2023, 1, 5, "本科批", None, 1, "g", None, 600, 900, None, 1.0, 1), (2, 1, 10, None, 2022, 1, 5, "本科批", None, None, None, None, 590, None, 1, None, None),
            (3, 1, 11, None, 2023, 1, 5, "本科批", None, None, None, "物理学类", None, 700, None, None, None), (4, 2, 11, None, 2023, 1, 5, "本科批", None, None, None, None, 1, 1, None, None, None),
            (5, 3, 11, None, 2022, 1, 5, "本科批", None, None, None, None, 1, 1, None, None, None)),
        "school_majors": t("school_id int, major_id int, is_featured_major boolean, major_strength_rank int, major_strength_score int, strength_evidence string", (1, 10, None, None, None, "[]")),
        "school_major_strength_signals": t("id int, school_id int, major_id int", (1, 1, 10), (2, 1, 10)),
    }


def test_audits(spark):
    x = _tables(spark)
    cover = {r.year: r.asDict() for r in audits.year_coverage(x, "辽宁", [2024, 2023, 2021, 2023]).collect()}
    assert sorted(cover) == [2021, 2023, 2024] and cover[2023] | {"admission_schools": 2, "admission_records": 3, "admission_records_with_plan_count": 1, "admission_majors": 2, "missing_plan_schools": 2, "plan_records": 0} == cover[2023]
    assert cover[2024] | {"plan_schools": 1, "plan_records": 4, "plan_count_sum": 14, "plan_majors": 1, "plan_records_with_selection_requirement": 3, "missing_plan_schools": 0, "province_code": "21"} == cover[2024]
    assert set(v for k, v in cover[2021].items() if k not in ("year", "province_code", "province_name")) == {0}
    gaps = audits.plan_gaps(x, "21", [2022, 2023, 2024]).collect()
    assert [(r.year, r.school_name, r.admission_records) for r in gaps] == [(2023, "甲", 2), (2023, "乙", 1), (2022, "甲", 1), (2022, None, 1)]
    ready = audits.readiness(x, "辽宁", 2024, [2023, 2022])
    lacks = {r.enrollment_plan_id: set(r.readiness_flags) for r in ready.collect()}
    assert lacks[1] == {"missing_admission_min_rank"} and lacks[5] == lacks[1] and set(lacks) == {1, 2, 3, 5}
    assert len(lacks[2]) == 8 and lacks[3] == {"missing_admission_linkage", "missing_admission_min_score", "missing_admission_min_rank", "missing_strength_evidence"}
    assert [r.enrollment_plan_id for r in audits.readiness_gaps(ready, 3).collect()] == [2, 3, 1]
    total = audits.readiness_summary(ready).collect()[0].asDict()
    assert (total["plan_major_count"], total["answer_ready_count"], total["gap_count"], total["missing_admission_min_rank"], total["missing_plan_count"]) == (4, 0, 4, 4, 1)
    assert audits.readiness_summary(audits.readiness(x, "辽宁", 2024, [2023])).collect()[0].answer_ready_count == 2


def test_diagnostics(spark):
    x = _tables(spark)
    met = audits.match_diagnostics(x, "辽宁", 2024, [2023, 2022]).collect()[0].asDict()
    assert list(met.values()) == [3, 1, 1, 1, 1, 2, 1, 2, 1, 0, 1, 1]  # major 10 once, by id and by name; 物理学 by name, with a rank; 化学 not
    assert list(audits.match_diagnostics(x, "辽宁", 2024, [2023], None, "本科批").collect()[0])[0] == 3 and list(audits.match_diagnostics(x, "辽宁", 2024, [2023], 5, "提前批").collect()[0])[0] == 0
    assert list(audits.strength_diagnostics(x, "辽宁", 2024).collect()[0]) == [3, 1, 1, 0, 1]
    with_evidence = x | {"school_majors": x["school_majors"].replace("[]", '["a"]')}
    assert list(audits.strength_diagnostics(with_evidence, "辽宁", 2024).collect()[0]) == [3, 1, 1, 1, 0]
    for nowhere in (audits.match_diagnostics(x, "?", 2024, [2023]), audits.strength_diagnostics(x, "?", 2024), audits.readiness_summary(audits.readiness(x, "?", 2024, [2023]))):
        assert set(nowhere.collect()[0]) == {0}
    assert audits.year_coverage(x, "?", [2023]).count() == 0 and audits.plan_gaps(x, "?", [2023]).count() == 0


def _chain_tables(spark, plans, results):
    ids = "school_id int, major_id int, year int, province_id int, subject_category_id int, batch string, batch_code string, batch_category string, batch_segment string, major_group_code string, major_code_raw string, campus string, plan_count int, "
    texts = ", ".join(f"{c} string" for c in (*candidates.GREATEST[2:], *candidates.OF_PLANS))
    p = spark.createDataFrame([(*r, *[None] * (5 + 6)) for r in plans], ids + "major_name string, " + texts)
    r = spark.createDataFrame([(*r, *_NO) for r in results], ids + "min_score int, min_rank int, admitted_count int, school_code_raw string, " + ", ".join(f"{c} string" for c in candidates.GREATEST[2:]))
    schools = spark.createDataFrame([(1, "甲", "c"), (2, "乙", None)], "id int, name string, city string")
    majors = spark.createDataFrame([(10, "1", "数学"), (11, "2", "物理"), (12, "3", "物理")], "id int, code string, name string")
    taught = spark.createDataFrame([(1, 10, 1, None, None, None, None, None), (1, 11, 2, 3, 50, "t", True, "[]")], "school_id int, major_id int, school_major_display_order int, major_strength_rank int, major_strength_score int, major_strength_tier string, is_featured_major boolean, strength_evidence string")
    return r, p, schools, majors, taught


def test_admission_chain(spark):
    key, other = ("本科批", None, None, None), ("x", "regular", "普通批", None)
    fact = lambda s, m, y, b=key, rank=1000, code=None: (s, m, y, 1, 5, *b, None, code, None, 4, 600, rank, 2, "A1")
    plan = lambda s, m, name, b=key, code=None, n=3: (s, m, 2024, 1, 5, *b, None, code, None, n, name)
    results = [
        fact(1, 10, 2023), fact(1, 10, 2021, other, 90000), fact(1, 10, 2020), fact(1, 11, 2022, other, 1200), fact(1, 12, 2022, rank=9999), fact(2, 11, 2023, rank=None), fact(2, 12, 2023, rank=1300), fact(2, 11, 2022, rank=800),
        fact(1, None, 2023), fact(2, 10, 2023, ("x", "regular", "普通批", "A段")), fact(2, 10, 2024), fact(9, 10, 2023), fact(1, 99, 2023),
    ]
    plans = [
        plan(1, 10, "any", code="b"), plan(1, 10, "any", other, "a", None), plan(1, 10, "any", code=None), plan(1, None, "数学"), plan(1, None, "物理"), plan(2, None, "物理"), plan(2, 10, "数学"), plan(2, 12, "别名", ("y", None, None, None)),
        plan(1, None, "数学", ("x", "regular", "普通批", None)), plan(1, 77, "数学", ("x", None, None, None)),
    ]
    out = candidates.admission_chain(*_chain_tables(spark, plans, results), 1, 2024, 5, "本科批", 1000, 500)
    rows = {(r.school_id, r.major_id): r for r in out.collect()}
    assert set(rows) == {(1, 10), (1, 11), (2, 11), (2, 12)}  # 12 of school 1 never near, 99 and school 9 unknown, 2020 and 2024 outside
    a = rows[1, 10]
    assert [h.year for h in a.admission_history] == [2023, 2021] and a.rank_distance == 0 and a.school_code_raw == "A1" and a.batch == "本科批" and not a.is_featured_major
    # three identified plans; the loose one named 数学 in 本科批 counts too; the one in x has an identified namesake there, of another code
    assert [(o.major_code_raw, o.major_name) for o in a.current_plan_options] == [("a", "any"), ("b", "any"), (None, "any"), (None, "数学")] and a.current_plan_count == 9
    b = rows[1, 11]
    assert b.current_plan_count == 3 and b.is_featured_major and b.batch == "本科批" and b.batch_code == "regular" and b.historical_plan_count == 4
    assert rows[2, 11].current_plan_count is None and rows[2, 12].current_plan_options is None  # two candidates of one name: not by name
    assert [h.min_rank for h in rows[2, 11].admission_history] == [None, 800] and rows[2, 11].rank_distance == 200 and rows[2, 12].rank_distance == 300
    assert [(r.school_id, r.major_id) for r in out.orderBy(*candidates.in_chain_order()).collect()] == [(1, 10), (1, 11), (2, 11), (2, 12)]
    empty = _chain_tables(spark, [], [])
    assert candidates.admission_chain(*empty, 1, 2024, None, "本科批", 1000).count() == 0
    assert all(len(set(x)) == len(x) for x in itertools.chain([candidates.OPTION], [candidates.PAST], [out.columns]))


def test_command_line(spark, tmp_path, capsys):
    from siftwell import __main__

    for name, df in _tables(spark).items():
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert __main__.main(["audit-years", str(tmp_path), "--province", "辽宁", "--year", "2023", "--year", "2024"], spark) == 0
    said = capsys.readouterr().out
    assert "year_coverage" in said and "plan_gaps" in said and "辽宁" in said
    assert __main__.main(["audit-majors", str(tmp_path), "--province", "21", "--plan-year", "2024", "--year", "2023", "--year", "2022", "--batch", "本科批", "--limit", "1"], spark) == 0
    said = capsys.readouterr().out
    assert all(x in said for x in ("summary", "matches", "strength", "gaps", "missing_admission_linkage"))


def test_strength_diagnostics_groups_only_the_plans_schools(spark):
    """Taught majors and signals of other schools are left out by joins that keep nothing of them."""
    import __spark_entry__

    plan = __spark_entry__.queries()["audit_strength_diagnostics"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert sum("Join LeftSemi" in line for line in plan) >= 2
