"""Rows of known tables (A-6 to A-8, A-18, A-19, A-21, A-23, A-26, A-32): which column is which, then typed columns.

All start from `html_tables.table_rows`. A header counts for the rows below it in its table, until the next one;
columns that no header names are taken by position, where a table has one. One shuffle, on (page, table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions import classify, dates, hashing, text
from siftwell.sources.html_tables import table_rows
from siftwell.sources.json_payloads import objects

#: The labels of each column, and its place (from 0) where no header has one of them; -1 for none.
ADMISSION = {
    "major_name_raw": (["专业名称", "专业"], 0), "subject_category_raw": (["科类", "选科"], 1), "batch": (["批次"], 2), "min_score": (["最低分", "最低分数"], 3),
    "min_rank": (["最低位次", "最低排名"], 4), "avg_score": (["平均分"], 5), "admitted_count": (["录取人数", "录取数"], 6), "plan_count": (["计划数", "招生人数"], -1),
    "school_code_raw": (["院校代码", "学校代码"], -1), "school_name_raw": (["院校名称", "学校名称"], -1), "major_group_code": (["院校专业组", "专业组", "专业组代码"], -1),
    "major_code_raw": (["专业代码"], -1), "campus": (["校区"], -1), "remark": (["备注", "说明"], -1),
}
PLAN = {
    "major_name": (["专业名称", "专业"], 0), "subject_category_raw": (["科类", "选科"], 1), "batch": (["批次"], 2), "plan_count": (["计划数"], 3), "duration": (["学制"], 4),
    "tuition": (["学费"], 5), "note": (["备注", "说明"], 6), "major_group_code": (["院校专业组", "专业组", "专业组代码"], -1), "major_code_raw": (["专业代码"], -1),
    "selection_requirement": (["选科要求", "再选科目"], -1), "campus": (["校区"], -1), "education_location": (["办学地点", "就读地点"], -1), "school_code_raw": (["院校代码", "学校代码"], -1),
}
THIRD_PARTY = {
    "year_text": (["年份"], -1), "province_name": (["省份", "录取省份"], -1), "major_name_raw": (["专业名称", "专业"], -1), "subject_category_raw": (["科类", "选科", "类别"], -1),
    "batch": (["类别", "批次", "录取批次"], -1), "requirement": (["选考要求", "选科要求"], -1), "min_score": (["最低分", "最低分数"], -1), "avg_score": (["平均分"], -1),
    "max_score": (["最高分"], -1), "admitted_count": (["录取人数", "录取数"], -1),
}
SEGMENT = {"score": (["分数", "分数段"], 0), "segment_count": (["本段人数", "人数", "同分人数"], 1), "cumulative_count": (["累计人数", "累计", "位次"], 2), "category": (["科类", "类别"], -1)}
NOT_BATCHES = ["批次", "类别", "科类", "填报阶段"]


def candidates(rows: DataFrame, ident: str, expected: list[str], table_class: str | None = None) -> DataFrame:
    """A-5: rows of tables with a header cell that contains an expected label; where a page has tables of the class, only those."""
    fits = F.col("is_header") & F.exists("cells", lambda c: text.has(c, *expected))
    w, page = Window.partitionBy(ident, "table_no"), Window.partitionBy(ident)
    of_class = F.array_contains(F.split("table_class", r"\s+"), table_class) if table_class else F.lit(False)
    seen = rows.withColumn("_class", of_class).withColumn("_any", F.max("_class").over(page)).withColumn("_fits", F.max(fits).over(w))
    return seen.filter(F.col("_fits") & (F.col("_class") | ~F.col("_any"))).drop("_class", "_any", "_fits")


def columns(rows: DataFrame, ident: str, spec: dict, is_head: Column, within: bool = False) -> DataFrame:
    """I-20: ident, table_no, row_no, n_cells, `_head` and a text column for each of spec, of the rows that aren't headers.
    within: a header cell only has to contain the label."""
    order = Window.partitionBy(ident, "table_no").orderBy("row_no")
    body = rows.withColumn("_h", is_head).withColumn("_head", F.last(F.when(F.col("_h"), F.col("cells")), True).over(order)).filter("NOT _h")
    head, n = F.coalesce("_head", F.array().cast("array<string>")), F.size(F.coalesce("_head", F.array().cast("array<string>")))

    def place(label: str) -> Column:
        if within:
            return F.nullif(F.array_position(F.transform(head, lambda h: F.contains(h, F.lit(label))), True), F.lit(0))
        back = F.array_position(F.reverse(head), label)  # of equal labels the last counts
        return F.when(back > 0, n - back + 1)

    def cell(labels: list[str], default: int) -> Column:
        at = F.coalesce(*[place(x) for x in labels], F.lit(default + 1 if default >= 0 else None).cast("bigint")).cast("int")
        return F.when(at >= 1, F.nullif(F.trim(F.get("cells", at - 1)), F.lit("")))

    return body.select(ident, "table_no", "row_no", F.size("cells").alias("n_cells"), "_head", *[cell(*how).alias(c) for c, how in spec.items()])


def _batch(df: DataFrame) -> DataFrame:
    b = classify.batch("batch")
    return df.withColumn("_b", b).withColumns({"batch_code": F.col("_b.code"), "batch_category": F.col("_b.category"), "batch_segment": F.col("_b.segment")}).drop("_b")


def _rules(df: DataFrame, note: str) -> DataFrame:
    r = classify.RULES
    political, physical = classify.rule(note, r["political_review"]), classify.rule(note, r["physical_exam"])
    return df.withColumns({"program_type": classify.program_type("batch", note), "physical_exam_or_political_review": classify.join_rules(physical, political), "political_review_requirement": political, "service_obligation": classify.rule(note, r["service"])})


def admission_table(pages: DataFrame, html: str, ident: str) -> DataFrame:
    """A-6: official results; rows under five cells, without a major or without a batch go."""
    rows = candidates(table_rows(pages, html, ident), ident, ["专业", "批次", "最低分"], "admission-table")
    out = columns(rows, ident, ADMISSION, F.col("is_header")).filter("n_cells >= 5 AND major_name_raw IS NOT NULL AND batch IS NOT NULL")
    numbers = ("min_score", "min_rank", "avg_score", "admitted_count", "plan_count")
    out = _rules(_batch(out.withColumns({c: text.digits_only(c) for c in numbers})), "remark")
    out = out.withColumn("min_rank_source", F.when(F.col("min_rank").isNotNull(), "official"))
    return out.withColumn("quality_flags", hashing.missing_flags(out, ["min_score", "min_rank", "admitted_count"])).drop("_head", "n_cells")


def plan_table(pages: DataFrame, html: str, ident: str) -> DataFrame:
    """A-8: plans; rows under three cells or without a major go."""
    rows = candidates(table_rows(pages, html, ident), ident, ["专业", "批次", "计划数"], "plan-table")
    out = columns(rows, ident, PLAN, F.col("is_header")).filter("n_cells >= 3 AND major_name IS NOT NULL")
    out = _rules(_batch(out.withColumn("plan_count", text.digits_only("plan_count"))), "note")
    return out.withColumn("quality_flags", hashing.missing_flags(out, ["plan_count", "selection_requirement"])).drop("_head", "n_cells")


def third_party_table(pages: DataFrame, html: str, ident: str, context: str) -> DataFrame:
    """A-7: results of all provinces in one page. A header names a major and a lowest or highest score, in cells of any kind; rows
    above it go. context: the text around the table, which gives a year or a province that the row lacks. Ranks are
    `joins.asof_floor` over the segments, by the caller."""
    is_head = F.exists("cells", lambda c: F.contains(c, F.lit("专业"))) & F.exists("cells", lambda c: text.has(c, "最低分", "最高分"))
    out = columns(table_rows(pages, html, ident), ident, THIRD_PARTY, is_head).filter("_head IS NOT NULL AND major_name_raw IS NOT NULL")
    out = out.join(pages.select(ident, F.col(context).alias("_context")), ident)
    out = out.withColumn("year", F.coalesce(text.year("year_text"), text.year("_context"))).filter("year IS NOT NULL")
    out = out.withColumns({c: text.score(c) for c in ("min_score", "avg_score", "max_score")} | {"admitted_count": text.digits_only("admitted_count"), "batch": F.coalesce("batch", F.lit("普通类"))})
    out = _batch(out).withColumns({"subject_category": classify.subject("subject_category_raw"), "remark": F.when(F.col("requirement").isNotNull(), F.concat(F.lit("选考要求: "), "requirement")), "min_rank": F.lit(None).cast("int")})
    return out.withColumn("quality_flags", hashing.missing_flags(out, ["min_score", "min_rank", "admitted_count"])).drop("_head", "n_cells", "year_text", "requirement")


def segment_table(pages: DataFrame, html: str, ident: str, hint: str | None = None) -> DataFrame:
    """A-18, A-21: score segments by headers that contain the labels, else by position; rows with a number missing go."""
    is_head = F.exists("cells", lambda c: F.contains(c, F.lit("分数"))) & F.exists("cells", lambda c: text.has(c, "人数", "累计"))
    out = columns(table_rows(pages, html, ident), ident, SEGMENT, is_head, within=True).filter("n_cells >= 3 AND _head IS NOT NULL")
    out = out.withColumns({"score": text.first_integer("score"), "segment_count": text.strict_count("segment_count"), "cumulative_count": text.strict_count("cumulative_count"), "category": F.coalesce("category", F.lit(hint), F.lit(""))})
    return out.filter("score IS NOT NULL AND segment_count IS NOT NULL AND cumulative_count IS NOT NULL").drop("_head", "n_cells")


def legacy_segments(pages: DataFrame, html: str, ident: str) -> DataFrame:
    """A-19: three or four cells by position, in tables of the class; counts that are no numbers are 0."""
    rows = table_rows(pages, html, ident).filter(F.array_contains(F.split("table_class", r"\s+"), "segment-table") & ~F.col("is_header") & (F.size("cells") >= 3))
    cell = lambda i: F.get("cells", F.lit(i))
    out = rows.select(ident, "table_no", "row_no", text.strict_count(cell(0)).alias("score"), *[F.coalesce(text.strict_count(cell(i)), F.lit(0)).alias(c) for i, c in ((1, "segment_count"), (2, "cumulative_count"))], F.coalesce(cell(3), F.lit("")).alias("category"))
    return out.filter("score IS NOT NULL")


def timeline_table(pages: DataFrame, html: str, ident: str, year: str) -> DataFrame:
    """A-23, A-26: batch, start and end. A row of one cell says whether the rows below, in its table, are of the collection round."""
    first = F.regexp_replace(F.get("cells", F.lit(0)), text.SPACE, "")
    order = Window.partitionBy(ident, "table_no").orderBy("row_no")
    rows = table_rows(pages, html, ident).withColumn("_b", first).withColumn("_round", F.coalesce(F.last(F.when(F.size("cells") < 2, F.contains(F.col("_b"), F.lit("征集"))), True).over(order), F.lit(False)))
    when = F.regexp_replace(F.regexp_replace(F.get("cells", F.lit(1)), text.SPACE, ""), "：", ":")
    rows = rows.filter(F.size("cells") >= 2).withColumn("_t", when).filter((F.col("_b") != "") & ~F.col("_b").isin(NOT_BATCHES) & ~F.contains(F.col("_t"), F.lit("时段")))
    out = rows.join(pages.select(ident, F.col(year).alias("_year")), ident).withColumn("_r", dates.time_range("_t", F.col("_year")))
    named = F.when(F.col("_round") & ~F.contains(F.col("_b"), F.lit("征集")), F.concat("_b", F.lit("(征集志愿)"))).otherwise(F.col("_b"))
    return out.filter("_r.start IS NOT NULL").select(ident, "table_no", "row_no", named.alias("batch"), F.col("_r.start").alias("start_time"), F.col("_r.end").alias("end_time"))


def satisfaction(payloads: DataFrame, column: str) -> DataFrame:
    """A-32: scores by kind from msg.schappraisalinfo; rows without any score go, as do payloads of another shape."""
    ratings = objects(F.get_json_object(column, "$.msg.schappraisalinfo"), "struct<type: string, avgRank: string, count: string>")
    kind = lambda n: F.try_element_at(F.filter("_ratings", lambda r: r.type == n), F.lit(-1))
    known = payloads.withColumn("_ratings", ratings).filter(F.size("_ratings") > 0)
    known = known.withColumns({"_all": kind("综合"), "_at": F.coalesce(kind("院校"), kind("环境")), "_life": kind("生活")})
    out = known.withColumns({"overall_score": text.safe("_all.avgRank", "double"), "environment_score": text.safe("_at.avgRank", "double"), "life_score": text.safe("_life.avgRank", "double"), "vote_count": text.safe("_all.count", "int")})
    return out.filter("coalesce(overall_score, environment_score, life_score) IS NOT NULL").drop("_ratings", "_all", "_at", "_life")
