"""Links and article texts of pages (A-15 to A-17, A-22, A-24, A-27 to A-30), nested catalogues (A-38, A-39, I-66)."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions import classify, dates, text
from siftwell.operators.joins import longest_contained
from siftwell.sources.json_payloads import objects

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_LINK = pa.struct([("pos", pa.int32()), ("href", pa.string()), ("title", pa.string()), ("code", pa.string()), ("parts", pa.list_(pa.string())), ("classes", pa.list_(pa.string()))])
_BLOCK = pa.struct([("pos", pa.int32()), ("tag", pa.string()), ("ident", pa.string()), ("classes", pa.list_(pa.string())), ("body", pa.string())])


class _Page(HTMLParser):
    """Links with the classes they are under, and the texts of elements that have a class or an id."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open, self.links, self.blocks, self.link, self.mute = [], [], [], None, 0

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        a = {k: v or "" for k, v in attrs}
        classes = a.get("class", "").split()
        self.mute += tag in ("script", "style")
        block = None
        if classes or a.get("id") or tag in ("h1", "title"):
            block = {"pos": len(self.blocks), "tag": tag, "ident": a.get("id"), "classes": classes, "body": []}
            self.blocks.append(block)
        if tag == "a" and "href" in a:
            above = [c for _, b in self.open if b for c in b["classes"]]
            self.link = {"pos": len(self.links), "href": a["href"].strip(), "title": a.get("title"), "code": a.get("data-code", "").strip() or None, "parts": [], "classes": above + classes}
            self.links.append(self.link)
        self.open.append((tag, block))

    def handle_endtag(self, tag):
        if not any(t == tag for t, _ in self.open):
            return
        while True:
            t, _ = self.open.pop()
            self.mute -= t in ("script", "style")
            if t == "a":
                self.link = None
            if t == tag:
                return

    def handle_data(self, data):
        if self.mute or not data.strip():
            return
        if self.link is not None:
            self.link["parts"].append(data.strip())
        for _, b in self.open:
            if b:
                b["body"].append(data)


def _parse(html: str | None) -> _Page:
    p = _Page()
    p.feed(html or "")
    p.close()
    return p


def _each(pages: DataFrame, html: str, ident: str, kind: pa.StructType, ddl: str, take) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, h in enumerate(b.column(1)):  # a page at a time: nested blocks repeat its text
                found = take(_parse(h.as_py()))
                if found:
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i] * len(found))), *pa.array(found, kind).flatten()], names=[ident, *[f.name for f in kind]])

    return pages.select(ident, html).mapInArrow(run, f"{ident} {pages.schema[ident].dataType.simpleString()}, {ddl}")


def links(pages: DataFrame, html: str, ident: str) -> DataFrame:
    """ident, pos (from 0), href, title, code (data-code), parts (texts), classes (its own and those above)."""
    return _each(pages, html, ident, _LINK, "pos int, href string, title string, code string, parts array<string>, classes array<string>", lambda p: p.links)


def blocks(pages: DataFrame, html: str, ident: str) -> DataFrame:
    """ident, pos, tag, id_attr, classes, body (raw text, whole)."""
    take = lambda p: [b | {"body": " ".join(b["body"])} for b in p.blocks]
    return _each(pages, html, ident, _BLOCK, "pos int, tag string, id_attr string, classes array<string>, body string", take)


def article(pages: DataFrame, html: str, ident: str, choices: list[str], most: int, least: int = 1) -> DataFrame:
    """A-27 to A-30: one text a page: of the first of `choices` (.class, #id or tag) with at least `least` characters; cut at
    `most`, as the tables hold. Pages without one: no row."""
    def fits(c: str):
        return F.array_contains("classes", c[1:]) if c[0] == "." else F.col("id_attr") == c[1:] if c[0] == "#" else F.col("tag") == c

    rank = F.coalesce(*[F.when(fits(c), i) for i, c in enumerate(choices)])
    found = blocks(pages, html, ident).withColumn("_k", rank).filter("_k IS NOT NULL").withColumn("content", text.clean_text("body"))
    found = found.filter(F.length("content") >= least)
    best = found.groupBy(ident).agg(F.min_by("content", F.struct("_k", "pos")).alias("content"))
    return best.select(ident, text.cut("content", most).alias("content"))


#: Fixed values.
ANNOUNCEMENT_WORDS = ["高考", "普通高校", "招生", "录取", "志愿", "考试", "公告", "通知", "安排"]
SEGMENT_WORDS = ["一分一段", "一分段", "成绩分段", "成绩分数段", "成绩分布", "分段表"]
MAJOR_LISTS = ["yxk-zyjs-tab", "major-list"]


def first_of_url(found: DataFrame, order: list[str], url: str = "url") -> DataFrame:
    """A-15: the first row of each address."""
    return found.withColumn("_r", F.row_number().over(Window.partitionBy(url).orderBy(*order))).filter("_r = 1").drop("_r")


def major_links(pages: DataFrame, html: str, ident: str) -> DataFrame:
    """A-16, A-17: a school's majors in order (from 1) with the codes of their links and what their label says of their strength."""
    found = links(pages, html, ident).filter(F.arrays_overlap("classes", F.array(*map(F.lit, MAJOR_LISTS))))
    raw = F.nullif(F.array_join("parts", " "), F.lit(""))
    out = found.select(
        ident, (F.row_number().over(Window.partitionBy(ident).orderBy("pos"))).alias("display_order"), F.get("parts", F.lit(0)).alias("name"), raw.alias("raw_text"), F.nullif("href", F.lit("")).alias("href"),
        F.nullif(F.regexp_extract("href", r"[?&]specId=([^&#]*)", 1), F.lit("")).alias("source_id"), F.col("code").alias("data_code"), text.url_code("href", "code").alias("href_code"),
    )
    return out.withColumn("_s", classify.strength_signal(F.coalesce("raw_text", F.lit("")))).select("*", "_s.*").drop("_s")


def announcements(pages: DataFrame, html: str, ident: str, base: str, hosts: list[str]) -> DataFrame:
    """A-30: links whose title has a keyword and whose host is allowed; the first of an address stays."""
    url = F.when(F.col("href").rlike("(?i)^https?://"), F.col("href")).otherwise(F.concat(F.lit(base.rstrip("/")), F.lit("/"), F.regexp_replace("href", "^/+", "")))
    found = links(pages, html, ident).withColumn("label", text.clean_text(F.array_join("parts", " "))).filter(text.has(F.col("label"), *ANNOUNCEMENT_WORDS))
    found = found.withColumn("url", url).filter(F.lower(F.regexp_extract("url", r"(?i)^https?://([^/?#]*)", 1)).isin([h.lower() for h in hosts]))
    day = F.regexp_extract(F.concat_ws(" ", "title", "label"), r"(20\d{2})[-./年](\d{1,2})[-./月](\d{1,2})", 0)
    return first_of_url(found, [ident, "pos"]).select(ident, "pos", "url", "label", F.nullif(day, F.lit("")).alias("date_text"))


def index_targets(pages: DataFrame, html: str, ident: str, provinces: DataFrame, years: list[int]) -> DataFrame:
    """A-20, A-22: links that name a province (the longest such name), a keyword and an allowed year. provinces: id, name."""
    found = links(pages, html, ident).withColumn("label", F.array_join("parts", "")).filter(F.col("href") != "").filter(text.has(F.col("label"), *SEGMENT_WORDS))
    found = found.withColumn("year", text.year(F.concat_ws(" ", "label", "href"))).filter(F.col("year").isin(years))
    names = provinces.select(F.col("name"))
    named = longest_contained(found.select(ident, "pos", "href", "label", "year"), "label", [ident, "pos"], names, "name", "province_name")
    return first_of_url(named.filter("province_name IS NOT NULL"), [ident, "pos"], "href")


def timeline_text(articles: DataFrame, ident: str, body: str, year: str) -> DataFrame:
    """A-24, A-25: batch and times of sentences like `批次填报时间:…`. A line that is a heading with a year counts for the lines
    below it; where an article has one, lines above the first go."""
    order = Window.partitionBy(ident).orderBy("_line")
    lines = articles.select(ident, F.col(year).alias("_y"), F.posexplode(F.split(body, "\n")).alias("_line", "_text"))
    heading = F.contains("_text", F.lit("志愿填报时间")) & ~F.col("_text").rlike("[:：]|至") & F.col("_text").rlike(r"20\d{2}")
    lines = lines.withColumn("_own", F.when(heading, text.year("_text"))).withColumn("_sec", F.last("_own", True).over(order)).withColumn("_any", F.max("_own").over(Window.partitionBy(ident)))
    lines = lines.filter("_own IS NULL AND (_any IS NULL OR _sec IS NOT NULL)").withColumn("_y", F.coalesce("_sec", "_y"))
    parts = lines.select(ident, "_y", "_line", F.posexplode(F.split("_text", "[。；;]")).alias("_part", "_t"))
    p = r"([^:：。；;]*?)(?:志愿填报时间|填报时间)[:：]([^。；;]+)"
    parts = parts.withColumn("batch", F.regexp_replace(F.regexp_replace(F.regexp_extract("_t", p, 1), text.SPACE, ""), "^其中", "")).filter((F.col("batch") != "") & ~F.contains("batch", F.lit("高考")))
    when = F.regexp_replace(F.regexp_replace(F.regexp_extract("_t", p, 2), text.SPACE, ""), "：", ":")
    parts = parts.withColumn("_r", dates.time_range(when, F.col("_y"))).filter("_r.start IS NOT NULL")
    return parts.select(ident, "_line", "_part", "batch", F.col("_r.start").alias("start_time"), F.col("_r.end").alias("end_time"))


# ---- nested catalogues ----------------------------------------------------------------------------------------------

#: Fields of an item, and which of them are flags ("1" is yes).
ITEM = "struct<special_id: string, id: string, special_name: string, name: string, nation_feature: string, nation_first_class: string, is_important: string, province_feature: string, xueke_rank: string, xueke_rank_score: string, ruanke_rank: string, ruanke_level: string>"
FLAGS = ["nation_feature", "nation_first_class", "is_important", "province_feature"]
EVIDENCE = ["nation_feature", "nation_first_class", "province_feature", "is_important", "xueke_rank", "xueke_rank_score", "ruanke_rank", "ruanke_level"]
BUCKETS = ["1", "2", "3", "4", "nation_feature"]


def specials(payloads: DataFrame, column: str, ident: str) -> DataFrame:
    """A-38, I-66: items of the three nested shapes; of equal ids (else names) in one payload the first stays."""
    at = lambda path: F.get_json_object(column, path)
    grouped = F.flatten(F.transform(objects(at("$.data.special"), "struct<special: string>"), lambda g: objects(g["special"], ITEM)))
    flat = [objects(at(f"$.data.{b}"), ITEM) for b in BUCKETS]
    detail = F.coalesce(F.flatten(F.transform(F.map_values(F.from_json(at("$.data.special_detail"), "map<string, string>")), lambda v: objects(v, ITEM))), F.array().cast(f"array<{ITEM}>"))
    each = payloads.select(ident, F.posexplode(F.concat(grouped, *flat, detail)).alias("_pos", "i"))
    each = each.withColumns({"item_id": F.coalesce(text.as_text("i.special_id"), text.as_text("i.id")), "item_name": F.coalesce(text.as_text("i.special_name"), text.as_text("i.name"))}).filter("item_name IS NOT NULL")
    each = each.withColumn("_r", F.row_number().over(Window.partitionBy(ident, F.coalesce("item_id", "item_name")).orderBy("_pos"))).filter("_r = 1")
    featured = F.coalesce(F.greatest(*[F.coalesce(F.trim(f"i.{c}") == "1", F.lit(False)) for c in FLAGS]), F.lit(False))
    evidence = F.filter(F.array(*[F.struct(F.lit(c).alias("type"), F.col(f"i.{c}").alias("value")) for c in EVIDENCE]), lambda e: e.value.isNotNull() & ~F.trim(e.value).isin("", "0", "2", "null"))
    rank = lambda c: F.nullif(text.safe(f"i.{c}", "int"), F.lit(0))
    return each.select(
        ident, "item_id", "item_name", featured.alias("is_featured_major"), F.coalesce(rank("xueke_rank"), rank("ruanke_rank")).alias("major_strength_rank"),
        F.coalesce(text.as_text("i.xueke_rank_score"), text.as_text("i.ruanke_level")).alias("major_strength_tier"), evidence.alias("strength_evidence"),
    )


def major_details(payloads: DataFrame, column: str) -> DataFrame:
    """A-39: description, directions joined by 、, and degree."""
    at = lambda path: text.as_text(F.get_json_object(column, path))
    list_ = objects(F.get_json_object(column, "$.msg.jyfxInfo.jyfxList"), "struct<jyfx: string>")
    names = F.filter(F.transform(list_, lambda x: F.trim(x.jyfx)), lambda x: x != "")
    return payloads.withColumns({"description": F.coalesce(at("$.msg.zyjs.desc"), at("$.msg.zyjs.versionDesc")), "graduate_directions": F.nullif(F.array_join(names, "、"), F.lit("")), "degree": at("$.msg.xlcc")})
