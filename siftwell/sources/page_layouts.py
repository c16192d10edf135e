"""Fields of pages by declared layouts (A-14, A-28, A-33, A-40), by a table function.

A layout is a list of rules: which field, where (tags and classes, one within the other, as ``div.head span``), what of it. A
worker compiles a layout once; a page is parsed once for all its rules. What a later rule finds for a field stands before what an
earlier one found, so layouts go from the vague to the sure. In SQL: ``SELECT p.*, f.* FROM pages p, LATERAL
page_fields(p.html, '<layout as JSON>') f``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf


class Rule(NamedTuple):
    """take: `first`, `last` (text), `each` (a value for each match), `join` (texts, with `with_`), `attr` (of the first match),
    `has` (a match says just `with_`), `part` (says it among others), `label` (in a match that says `with_`, the first span with other words),
    `cells` (a value for each row: the text of its first cell and the hidden value of its second, with a tab)."""

    field: str
    where: str
    take: str
    with_: str = ""
    skip: str = ""  # texts with this word, and numbers, are passed over by `first`
    least: int = 0
    most: int = 0  # characters: fewer are none, more are cut


#: Fixed values of the sites: classes and labels.
SCHOOL_DETAIL = [
    Rule("name", "div.content-header", "first", skip="关注"),
    *[Rule(f"is_{k}", "div.content-introduction span", take, text) for k, take, text in (("211", "has", "211"), ("985", "has", "985"), ("double_first", "part", "双一流"), ("private", "has", "民办"), ("independent", "has", "独立学院"), ("sino_foreign", "has", "中外合作办学"))],
    Rule("logo_url", "div.yxxx-header-img img", "attr", "src"), Rule("introduction", "div.content-introduction", "join", " ", most=5000),
    Rule("authority", "div.content-introduction .department span", "last"), Rule("school_type", "div.content-introduction .yxtx span", "join", " | "),
    Rule("city", "span.yxszd", "first"), Rule("address", "span.txdz", "first"), Rule("phone", "span.gfdh", "first"),
    Rule("website", "a.gfwz", "attr", "href"), Rule("recruit_website", "a.zswz", "attr", "href"),
    *[Rule(f, "div.content-info-item", "label", text) for f, text in (("authority", "教育行政主管部门"), ("authority", "隶属于"), ("school_type", "院校特性"), ("school_type", "院校类型"))],
]
#: The one-shot readers' layouts: classes anywhere, the title before the last resort.
SCHOOL_PAGE = [
    Rule("name", "title", "first"), Rule("name", "div.content-header", "first", skip="关注"), Rule("logo_url", ".yxxx-header-img img", "attr", "src"), Rule("city", ".yxszd", "first"),
    Rule("address", ".txdz", "first"), Rule("phone", ".gfdh", "first"), Rule("website", ".gfwz", "attr", "href"), Rule("recruit_website", ".zswz", "attr", "href"),
    Rule("authority", ".department span", "last"), Rule("school_type", ".yxtx span", "join", " | "), Rule("level", ".sch-level-tag", "each"), Rule("introduction", ".content-introduction", "join", " ", most=5000),
]
CHARTER = [Rule("content", ".zszc-content.UEditor", "join", " ", least=80, most=50_000)]
MAJOR_SATISFACTION = [Rule("major", "table.myd-detail-table tbody tr", "cells")]
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: An ampersand that begins no reference closed by a semicolon, and the noncharacter that stands for it while a page is parsed.
OPEN, AMPERSAND = re.compile(r"&(?!(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);)"), "\ufdd0"


class Element(NamedTuple):
    tag: str
    classes: frozenset
    attrs: dict
    parent: int


class Page(HTMLParser):
    """Elements in order, each with where its subtree ends, and texts with their element. `closed`: references count only with
    their semicolon, so that a title cut off within one keeps its signs; else as browsers have it."""

    def __init__(self, html: str, closed: bool = False):
        super().__init__(convert_charrefs=True)
        self.closed = closed
        self.elements: list[Element] = []
        self.ends: list[int] = []
        self.texts: list[tuple[int, str]] = []
        self.open: list[int] = []
        self.by_tag: dict[str, list[int]] = {}
        self.feed(OPEN.sub(AMPERSAND, html) if closed else html)
        self.close()
        for i in self.open:
            self.ends[i] = len(self.elements)

    def handle_starttag(self, tag, attrs):
        attrs = {self.plain(k): self.plain(v or "") for k, v in reversed(attrs)}
        i = len(self.elements)
        self.elements.append(Element(tag, frozenset(attrs.get("class", "").split()), attrs, self.open[-1] if self.open else -1))
        self.ends.append(i + 1)
        for key in ("", tag):
            self.by_tag.setdefault(key, []).append(i)
        if tag not in VOID:
            self.open.append(i)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.elements[self.open[k]].tag == tag:
                for i in self.open[k:]:
                    self.ends[i] = len(self.elements)
                del self.open[k:]
                return

    def handle_data(self, data):
        if self.open:
            self.texts.append((self.open[-1], self.plain(data)))

    def plain(self, x: str) -> str:
        return x.replace(AMPERSAND, "&") if self.closed else x

    def words(self, i: int) -> list[str]:
        """The texts within an element, without white space around them and without empty ones."""
        return [x.strip() for at, x in self.texts if i <= at < self.ends[i] and x.strip()]


Step = tuple[str, frozenset]


def compiled(where: str) -> list[Step]:
    return [(tag, frozenset(classes)) for tag, *classes in (step.split(".") for step in where.split())]


def matches(page: Page, steps: list[Step]) -> Iterator[int]:
    fits = lambda i, s: (not s[0] or page.elements[i].tag == s[0]) and s[1] <= page.elements[i].classes
    for i in page.by_tag.get(steps[-1][0], ()):
        if fits(i, steps[-1]):
            at, left = page.elements[i].parent, len(steps) - 1
            while at >= 0 and left:
                left -= fits(at, steps[left - 1])
                at = page.elements[at].parent
            if not left:
                yield i


def found(page: Page, rule: Rule, steps: list[Step]) -> list[str]:
    at, words = matches(page, steps), page.words
    if rule.take == "attr":
        return [page.elements[i].attrs[rule.with_].strip() for i in at if rule.with_ in page.elements[i].attrs][:1]
    if rule.take in ("has", "part"):
        said = ["".join(words(i)) for i in at if "display: none" not in page.elements[i].attrs.get("style", "").lower()]
        return ["true"] if any(rule.with_ == x if rule.take == "has" else rule.with_ in x for x in said) else []
    if rule.take == "label":
        for i in at:
            if rule.with_ in " ".join(words(i)):
                for k in page.by_tag.get("span", ()):
                    own = [x.strip() for e, x in page.texts if e == k and x.strip() and x.strip() != rule.with_]
                    if i < k < page.ends[i] and own:
                        return own[:1]
        return []
    if rule.take == "cells":
        out = []
        for i in at:
            cells = [k for k in page.by_tag.get("td", ()) if i < k < page.ends[i]]
            name = "".join(words(cells[0])) if len(cells) > 1 else ""
            hidden = [page.elements[k].attrs.get("value", "").strip() for k in page.by_tag.get("input", ()) if name and cells[1] < k < page.ends[cells[1]] and page.elements[k].attrs.get("type") == "hidden"]
            out += [f"{name}\t{hidden[0] if hidden else ''}"] if name else []
        return out
    if rule.take == "each":
        return [x for x in (" ".join(words(i)) for i in at) if x]
    texts = [x for i in at for x in words(i) if not (rule.skip and (rule.skip in x or x.isdigit()))]
    return {"first": texts[:1], "last": texts[-1:], "join": [rule.with_.join(texts)] if texts else []}[rule.take]


def reader(rules: list[Rule], closed: bool = False) -> Callable[[str | None], list[tuple[str, int, str]]]:
    """(field, place, value) of a page by a compiled layout."""
    steps = [(r, compiled(r.where)) for r in rules]

    def read(html: str | None) -> list[tuple[str, int, str]]:
        page, values = Page(html or "", closed), {}
        for rule, own in steps:
            got = [x[: rule.most or None] for x in found(page, rule, own) if len(x) >= rule.least]
            if got:
                values[rule.field] = got
        return [(field, k, x) for field, got in values.items() for k, x in enumerate(got)]

    return read


@udtf(returnType="field string, place int, value string")
class PageFields:
    """page_fields(html, layout, closed): the layout is a JSON array of rules, and the same for all rows of a task, as `closed` is."""

    def __init__(self):
        self.read, self.layout = None, None

    def eval(self, html: str, layout: str, closed: bool = False):
        if (layout, closed) != self.layout:
            self.layout, self.read = (layout, closed), reader([Rule(*x) for x in json.loads(layout)], closed)
        yield from self.read(html)


def page_fields(pages: DataFrame, html: str, rules: list[Rule], keep: list[str], closed: bool = False) -> DataFrame:
    """The columns `keep` of each page with its fields: field, place (from 0) and value. A page without any has no row. `closed` as for Page."""
    spark = pages.sparkSession
    spark.udtf.register("page_fields", PageFields)
    layout = json.dumps([list(r) for r in rules], ensure_ascii=False)
    own = pages.select(*keep, F.col(html).alias("_html"))
    names = ", ".join(f"p.`{c}`" for c in keep)
    return spark.sql(f"SELECT {names}, f.field, f.place, f.value FROM {{p}} AS p, LATERAL page_fields(p._html, :layout, :closed) AS f", {"layout": layout, "closed": closed}, p=own)


def as_columns(fields: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """One row a page: the first value of each named field."""
    return fields.filter("place = 0").groupBy(*keys).agg(*[F.max(F.when(F.col("field") == n, F.col("value"))).alias(n) for n in names])


def major_satisfaction(pages: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """A-33: a row for each major of a satisfaction table, with its hidden score as a number; null if it is none."""
    rows = page_fields(pages, html, MAJOR_SATISFACTION, keep)
    cells = F.split("value", "\t")
    return rows.select(*keep, cells[0].alias("major_name"), cells[1].try_cast("double").alias("overall_score"))
