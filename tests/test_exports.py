"""History matching against plain rules, rows of the export by their cells, readiness of small scopes."""

import random
import re

from siftwell.plans import answer_readiness, exports, history


def plain(name):
    return re.sub(r"\s+|专业|类", "", re.sub(r"[（(].*?[）)]", "", name or "").lower())


def whole(name):
    return re.sub(r"\s+", "", (name or "").lower().replace("（", "(").replace("）", ")"))


def by_hand(p, past):
    """The id of the past row for a plan, or None."""
    scope = [h for h in past if h["school_id"] == p["school_id"] and h["subject"] == p["subject"]]
    mine = plain(p["canonical_name"] or p["full_name"])
    named = [h for h in scope if mine and plain(h["canonical_name"] or h["full_name"]) == mine]
    found = [(0, h) for h in named] + [(1, h) for h in scope if p["major_id"] is not None and h["major_id"] == p["major_id"] and h not in named]

    def fits(h):
        same_code = bool(p["major_code"]) and p["major_code"] == h["major_code"]
        same_name = whole(p["full_name"]) == whole(h["full_name"]) != ""
        if None not in (p["major_id"], h["major_id"]) and p["major_id"] != h["major_id"] and not same_code and not same_name:
            return False
        if any(p[c] and h[c] and p[c] != h[c] for c in ("school_code", "group_code", "major_code")):
            return False
        if plain(p["full_name"]) and plain(h["full_name"]) and plain(p["full_name"]) != plain(h["full_name"]):
            return False
        return same_code or same_name or "(" not in whole(p["full_name"]) or "(" not in whole(h["full_name"])

    def batch(h):
        if p["batch_code"] and h["batch_code"]:
            a, b = p["batch_segment"] or "", h["batch_segment"] or ""
            return -1 if p["batch_code"] != h["batch_code"] or (a and b and a != b) else 4 if a == b else 3
        return 0 if not p["batch_text"] or not h["batch_text"] else 2 if p["batch_text"] == h["batch_text"] else -1

    found = [x for x in found if fits(x[1])]
    if p["major_id"] is None and len({h["major_id"] for _, h in found} - {None}) > 1:
        return None
    best = max((batch(h) for _, h in found), default=-1)
    found = [x for x in found if batch(x[1]) == best >= 0]

    def closeness(h):
        code = bool(p["major_code"]) and h["major_code"] == p["major_code"]
        return 0 if code and p["school_code"] and h["school_code"] == p["school_code"] else 1 if code and p["group_code"] and h["group_code"] == p["group_code"] else 2 if code else 3 if whole(p["full_name"]) == whole(h["full_name"]) != "" else 4

    close = min((closeness(h) for _, h in found), default=0)
    found = [x for x in found if closeness(x[1]) == close]
    if len({(h["school_code"] or "", h["group_code"] or "", h["major_code"] or "", whole(h["full_name"])) for _, h in found}) != 1:
        return None
    full = lambda h: sum(h[c] is not None for c in ("min_rank", "min_score", "admitted_count", "plan_count"))
    return min(found, key=lambda x: (-full(x[1]), -x[1]["official"], x[0], x[1]["major_id"] is None, x[1]["major_id"] or 0, x[1]["history_id"]))[1]["history_id"]


def test_match_history(spark):
    rng = random.Random(12)

    def row(kind, i):
        full = rng.choice(["数学", "数学(师范)", "数学（师范）", "数学(中外)", "化学", "化学类"])
        out = {"school_id": rng.choice([1, 2]), "major_id": rng.choice([None, 10, 11]), "subject": rng.choice(["物理", ""]), "full_name": full, "canonical_name": rng.choice([None, full.split("(")[0].split("（")[0]])}
        out |= {c: rng.choice([None, None, "", "A", "B"]) for c in ("school_code", "group_code", "major_code")} | {"batch_code": rng.choice([None, "", "early", "regular"]), "batch_segment": rng.choice([None, "", "A段", "B段"]), "batch_text": rng.choice([None, "", "本科批"])}
        if kind == "h":
            out |= {"year": rng.choice([2022, 2023]), "official": rng.choice([0, 1])} | {c: rng.choice([None, 5]) for c in ("min_rank", "min_score", "admitted_count", "plan_count")}
        return {"plan_id" if kind == "p" else "history_id": f"{kind}{i:03d}"} | out

    plans, past = [row("p", i) for i in range(150)], [row("h", i) for i in range(120)]
    kinds = {"school_id": "int", "major_id": "int", "year": "int", "official": "int", "min_rank": "int", "min_score": "int", "admitted_count": "int", "plan_count": "int"}
    table = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in rows[0]))
    got = {(r.plan_id, r.year): r.history_id for r in history.match_history(table(plans), table(past), [2022, 2023]).collect()}
    want = {(p["plan_id"], y): by_hand(p, [h for h in past if h["year"] == y]) for p in plans for y in (2022, 2023)}
    assert got == {k: v for k, v in want.items() if v} and len(got) > 20


def test_export_cells(spark):
    """One plan with an admission of last year, a plan of the year before, a charter; one plan with nothing."""
    t = lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)
    provinces = t("id int, name string", (1, "辽宁"), (2, "北京"))
    subjects = t("id int, name string", (5, "物理类"), (6, "历史类"))
    majors = t("id int, name string, education_level string, subcategory_id int, category_id int", (10, "数学", "本科", 3, None))
    subs, cats = t("id int, name string, category_id int", (3, "数学类", 4)), t("id int, name string", (4, "理学"))
    fact = "id int, year int, province_id int, subject_category_id int, school_id int, major_id int, major_name string, batch string, batch_code string, batch_category string, batch_segment string, plan_count int, school_code_raw string, major_group_code string, major_code_raw string, "
    none = (None,) * 3
    plans = t(fact + "program_type string, duration string, tuition string, note string, selection_requirement string, adjustment_rule string",
        (1, 2024, 1, 5, 7, 10, "数学（师范）", "本科批", *none, 3, " 0123 ", None, "01", "公费师范", "四年", "5000", "备注", "首选物理,再选化学", "服从调剂"),
        (2, 2024, 1, 6, 7, None, "新专业", "本科批", *none, None, *none, None, None, None, None, None, "规则"),
        (3, 2022, 1, 5, 7, 10, "数学（师范）", "本科批", *none, 9, *none, None, None, None, None, None, None),
        (4, 2024, 2, 5, 7, 10, "数学", "本科批", *none, 9, *none, None, None, None, None, None, None),
    )
    results = t(fact.replace("major_name", "major_name_raw") + "admitted_count int, min_score int, min_rank int, data_source string", (21, 2023, 1, 5, 7, 10, "数学(师范)", "本科批", *none, None, *none, 4, 600, 1000, exports.OFFICIAL))
    schools = t("id int, sch_id int, name string, crawl_task_id int, level string, province_id int, city string, authority string, school_type string, is_211 boolean, is_985 boolean, is_double_first boolean, is_private boolean, is_independent boolean, is_sino_foreign boolean",
        (7, 77, "某大学", 1, "本科", 2, "市", "部", "综合", True, True, None, False, None, False))
    taught = t("school_id int, major_id int, major_strength_tier string, strength_evidence string", (7, 10, "national", '[{"signal_type": "first_class_major", "signal_level": "provincial"}]'))
    charters = t("id int, school_id int, year int, content string, source_url string", (1, 7, 2025, "later", "x"), (2, 7, 2023, "实行专业优先", None), (3, 7, 2022, "old", "y"), (4, 8, 2024, "other", "z"))
    asked = exports.export_plans(plans, provinces, schools, subjects, majors, subs, cats, taught, "辽宁", 2024)
    common, years = (provinces, subjects, majors, "辽宁"), [2023, 2022, 2021, 2020]
    held = exports.latest_charters(charters, plans, provinces, "辽宁", 2024)
    out = exports.export_rows(asked, exports.export_admissions(results, *common, years), exports.export_past_plans(plans, *common, years), held, 2024, "辽宁")
    rows = {r.plan_id: [r[f"c{i}"] for i in range(65)] for r in out.collect()}
    assert set(rows) == {"1", "2"} and [(r.year, r.content) for r in held.collect()] == [(2023, "实行专业优先")]
    url = exports.CHARTERS + "77.dhtml"
    school = ["北京", "市", None, "985/211", None, None, "部", "综合", "公办", "本科", *[None] * 7]
    assert rows["1"] == [
        "1", 2024, "辽宁", "本科批", "物理", "(公费师范)", "0123", "某大学", "01", "数学（师范）", "数学", "（师范）；备注", "化学", "本科", 3, "4", "5000", "理学", "数学类", None,
        4, 600, 1000, "本科批", None, None, None, None, None, 9, *[None] * 10, *school, "专业优先", url, None, None, None, "省一", None, None,
    ]
    assert rows["2"][9:15] == ["新专业", "新专业", None, None, "本科", None] and rows["2"][19] == "新增" and rows["2"][20:40] == [None] * 20
    assert exports.export_plans(plans, provinces, schools, subjects, majors, subs, cats, taught, "辽宁", 2024, "历史").select("plan_id").collect() == [(2,)]
    assert [r.plan_id for r in asked.orderBy(*exports.in_export_order(asked)).collect()] == [1, 2]


def test_target_province(spark):
    provinces = spark.createDataFrame([(1, "21", "辽宁"), (2, "辽宁", "别名"), (3, "11", "北京")], "id int, code string, name string")
    found = lambda x: [tuple(r) for r in answer_readiness.target_province(provinces, x).collect()]
    assert found("辽宁") == [(1, "21", "辽宁")] and found("11") == [(3, "11", "北京")] and found("x") == []
    facts = spark.createDataFrame([(1, 5, "本科批", None), (1, None, "x", "本科批"), (3, 5, "本科批", None)], "province_id int, subject_category_id int, batch string, batch_category string")
    count = lambda *a: answer_readiness.scoped(facts, answer_readiness.target_province(provinces, "辽宁"), *a).count()
    assert (count(None, None), count(5, None), count(None, "本科批"), count(5, "y")) == (2, 1, 2, 0)


def test_export_filters_its_province_where_it_reads(spark):
    """A province's few schools are picked before their facts meet other tables; of taught majors only the plans' schools count."""
    from siftwell.plans import export_queries as q

    x = q._tables(spark, "/root/testdata/sf0.001")
    facts = exports._facts(x["plans"], x["provinces"], x["subjects"], x["majors"], q.PLACE, [q.YEAR], None)
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan
    assert any("s_nationkey" in line and "= 3" in line for line in plan.split("\n") if "Filter" in line)
