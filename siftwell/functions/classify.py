"""Classifiers by ordered keywords (I-15 to I-18, I-33 to I-37)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwell.functions.text import _c, clean_text, has

#: Batch words, program keywords in order, rule keywords, subject codes.
IRREGULAR = ["艺术", "体育", "专项", "强基", "综合评价", "保送", "特殊"]
REGULAR = ["普通类", "普通批", "本科批", "本科一批", "本科二批", "专科批", "高职批"]
PROGRAMS = [("公费师范", "公费师范"), ("优师", "优师专项"), ("军校", "军校"), ("军事", "军校"), ("公安", "公安"), ("警校", "公安"), ("航海", "航海"), ("定向", "定向"), ("专项", "专项计划")]
RULES = {
    "eligibility": ["资格", "报考条件", "报名条件"],
    "political_review": ["政审", "政治考核", "政治审查"],
    "physical_exam": ["体检", "色盲", "色弱", "限报", "不招"],
    "single_subject": ["单科", "英语", "数学", "语文"],
    "adjustment": ["调剂"],
    "service": ["服务期", "服务年限", "定向就业", "服从分配", "协议"],
}


def ladder(text: Column, cases: list[tuple[str, str]], default: str | Column | None = None) -> Column:
    """The value of the first keyword that the text contains."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for word, value in cases:
        out = out.when(F.contains(text, F.lit(word)), value)
    return out.otherwise(default) if default is not None else out


def batch(x: Column | str) -> Column:  # I-15: struct(code, category, segment)
    t = F.trim(F.coalesce(_c(x), F.lit("")))
    early, regular = has(t, "提前批"), has(t, *REGULAR) & ~has(t, *IRREGULAR)
    segment = ladder(t, [(s, s) for s in ("A段", "B段", "C段")])
    return F.struct(F.when(early, "early").when(regular, "regular").alias("code"), F.when(early, "提前批").when(regular, "普通批").alias("category"), segment.alias("segment"))


def program_type(*texts: Column | str) -> Column:  # I-16
    return ladder(F.concat_ws(" ", *[_c(t) for t in texts]), PROGRAMS)


def rule(x: Column | str, words: list[str]) -> Column:  # I-17
    parts = F.transform(F.split(_c(x), r"[\n,，;；。.]"), lambda p: F.trim(p))
    return F.nullif(F.array_join(F.filter(parts, lambda p: (p != "") & has(p, *words)), ";"), F.lit(""))


def join_rules(*rules: Column) -> Column:  # I-18
    return F.nullif(F.concat_ws(";", *rules), F.lit(""))


def strength_signal(x: Column | str) -> Column:  # I-33: struct(signal_type, signal_level, strength_score, evidence_title)
    t = clean_text(x)
    national, provincial = has(t, "国家级") & has(t, "一流本科专业"), has(t, "省级") & has(t, "一流本科专业")
    featured = has(t, "国家特色专业", "国家级特色专业")
    return F.struct(
        F.when(national | provincial, "first_class_major").when(featured, "featured_major").alias("signal_type"),
        F.when(national, "national").when(provincial, "provincial").when(featured, "national").alias("signal_level"),
        F.when(national, 100).when(provincial, 70).when(featured, 80).alias("strength_score"),
        F.when(national, "国家级一流本科专业建设点").when(provincial, "省级一流本科专业建设点").when(featured, "国家级特色专业").alias("evidence_title"),
    )


def announcement(title: Column | str, content: Column | str) -> Column:  # I-34
    t = F.concat_ws(" ", F.coalesce(_c(title), F.lit("")), F.coalesce(_c(content), F.lit("")))
    return ladder(t, [("录取", "admission"), ("志愿", "volunteer"), ("招生", "enrollment"), ("考试", "exam")], "notice")


def enrollment_type(title: Column | str, default: Column) -> Column:  # I-35
    return ladder(_c(title), [("强基", "强基计划"), ("高校专项", "高校专项计划"), ("国家专项", "国家专项计划"), ("地方专项", "地方专项计划")], default)


def special_type(title: Column | str, default: Column) -> Column:  # I-35
    return ladder(_c(title), [("强基", "strong_foundation"), ("专项", "special_plan")], F.nullif(default, F.lit("")))


def subject(x: Column | str) -> Column:  # I-36
    t = clean_text(x)
    return F.when(t.isin("普通类", "普通"), "").when(has(t, "物理"), "物理类").when(has(t, "历史"), "历史类").when(has(t, "理"), "理科").when(has(t, "文"), "文科").otherwise(t)


def by_code(x: Column | str, codes: dict[str, str], default: Column) -> Column:  # I-37
    if not codes:
        return default
    table = F.create_map(*[F.lit(y) for kv in codes.items() for y in kv])
    return F.coalesce(F.try_element_at(table, _c(x)), default)
