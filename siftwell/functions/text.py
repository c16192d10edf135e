"""Scalar text functions, Column to Column (I-1 to I-14, I-19 to I-24, I-38 to I-48, I-63, I-65). White space is Unicode's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)\s+"
_FULL_DIGITS, _DIGITS = "０１２３４５６７８９", "0123456789"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_text(x: Column | str) -> Column:  # I-1
    return F.trim(F.regexp_replace(F.replace(F.coalesce(_c(x).cast("string"), F.lit("")), F.lit("\u00a0"), F.lit(" ")), SPACE, " "))


def stripped(x: Column | str) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def as_text(x: Column | str) -> Column:  # I-2
    return F.nullif(clean_text(x), F.lit(""))


def json_filled(x: Column | str) -> Column:
    """C-10: JSON that is there and is not an empty list; what can't be read is not there."""
    return F.coalesce(F.try_parse_json(_c(x)).isNotNull() & ~F.coalesce(F.json_array_length(_c(x)) == 0, F.lit(False)), F.lit(False))


def first_text(*values: Column | str) -> Column:  # I-3
    return F.coalesce(*[as_text(v) for v in values])


def join_note(*values: Column | str) -> Column:  # I-4
    return F.nullif(F.concat_ws("", *[as_text(v) for v in values]), F.lit(""))


def major_name_greedy(x: Column | str) -> Column:  # I-5: all between the first and the last bracket goes
    return F.lower(F.regexp_replace(_c(x), r"(?s)[（(].*[）)]|(?U:\s)+|专业|类", ""))


def major_name(x: Column | str) -> Column:  # I-6: each bracketed part goes
    return F.trim(F.lower(F.regexp_replace(F.regexp_replace(clean_text(x), r"[（(].*?[）)]", ""), r"(?U)\s+|专业|类", "")))


def full_name(x: Column | str) -> Column:  # I-7
    return F.regexp_replace(F.translate(F.lower(clean_text(x)), "（），", "(),"), SPACE, "")


def code(x: Column | str) -> Column:  # I-8
    return F.upper(F.regexp_replace(clean_text(x), SPACE, ""))


def batch_text(x: Column | str) -> Column:  # I-9
    return F.regexp_replace(clean_text(x), r"(?U)普通类|院校最低分|综合评价分数|[-—－()（）]|\s", "")


def subject_label(x: Column | str) -> Column:  # I-10, one trailing sign
    return F.regexp_replace(clean_text(x), "类$", "")


def subject_bare(x: Column | str) -> Column:  # I-10, all of them
    return F.replace(_c(x), F.lit("类"), F.lit(""))


def base_major(x: Column | str) -> Column:  # I-11
    return F.nullif(F.trim(F.substring_index(F.replace(clean_text(x), F.lit("（"), F.lit("(")), "(", 1)), F.lit(""))


def has_variant(x: Column | str) -> Column:  # I-12
    return full_name(x) != full_name(base_major(x))


def _drop(x: Column, words: list[str]) -> Column:
    for w in words:
        x = F.replace(x, F.lit(w), F.lit(""))
    return x


#: Suffixes of autonomous regions.
REGIONS = ["壮族自治区", "回族自治区", "维吾尔自治区", "自治区"]


def province(x: Column | str) -> Column:  # I-13 (a), suffix-aware
    return F.regexp_replace(F.regexp_replace(_drop(F.trim(_c(x)), REGIONS), "省$", ""), "市$", "")


def province_global_first(x: Column | str) -> Column:  # I-13 (b)
    return _drop(F.trim(_c(x)), ["省", "市", *REGIONS])


def province_global_last(x: Column | str) -> Column:  # I-13 (c)
    return _drop(F.trim(_c(x)), [*REGIONS, "省", "市"])


def school_name(x: Column | str) -> Column:  # I-14
    return F.translate(F.regexp_replace(_c(x), SPACE, ""), "()", "（）")


def fold_digits(x: Column | str) -> Column:
    return F.translate(_c(x), _FULL_DIGITS, _DIGITS)


def _int(x: Column) -> Column:
    return F.nullif(x, F.lit("")).try_cast("int")


def digits_only(x: Column | str) -> Column:  # I-19
    return _int(F.regexp_replace(fold_digits(x), "[^0-9]", ""))


def first_integer(x: Column | str) -> Column:  # I-21
    return _int(F.regexp_extract(F.replace(fold_digits(x), F.lit(","), F.lit("")), "[0-9]+", 0))


def strict_count(x: Column | str) -> Column:  # I-22
    t = F.trim(fold_digits(x))
    return F.when(t.rlike("^[0-9]+$"), t.try_cast("int"))


def score(x: Column | str) -> Column:  # I-23: toward zero
    return F.coalesce(F.trim(_c(x)).try_cast("double").try_cast("bigint").try_cast("int"), digits_only(x))


def year(x: Column | str, pattern: str = r"20\d{2}") -> Column:  # I-24
    return _int(F.regexp_extract(_c(x), f"({pattern})", 1))


#: Fixed values, stripped one after the other.
SELECTION_PREFIXES = ["首选物理,再选", "首选历史,再选", "物理+", "历史+"]


def selection_requirement(x: Column | str) -> Column:  # I-38
    out = clean_text(x)
    for p in SELECTION_PREFIXES:
        out = F.when(F.startswith(out, F.lit(p)), F.trim(F.substr(out, F.lit(len(p) + 1)))).otherwise(out)
    return F.nullif(out, F.lit(""))


def has(x: Column, *words: str) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(x, F.lit(w))
    return out


def education_level(level: Column | str, batch: Column | str) -> Column:  # I-39
    t, b = clean_text(level), clean_text(batch)
    return F.when(has(t, "职业") & has(t, "本科"), "职教本科").when(t != "", t).when(has(b, "专科", "高职"), "专科").when(has(b, "本科"), "本科")


def duration(x: Column | str) -> Column:  # I-40
    t = clean_text(x)
    out = F.when(t.rlike("[0-9]"), F.regexp_extract(t, r"[0-9]+(?:\.[0-9]+)?", 0))
    for n, sign in enumerate("一二三四五六七八", 1):
        out = out.when(has(t, sign), str(n))
    return F.nullif(out.otherwise(t), F.lit(""))


def plan_category(x: Column | str) -> Column:  # I-41
    t = clean_text(x)
    return F.when(~t.isin("", "普通", "普通类"), F.when(F.startswith(t, F.lit("(")), t).otherwise(F.concat(F.lit("("), t, F.lit(")"))))


def tags(is_985: Column, is_211: Column, double_first: Column, joined: bool = True) -> Column:  # I-42
    found = F.array_compact(F.array(F.when(is_985, "985"), F.when(is_211, "211"), F.when(double_first, "双一流")))
    return F.nullif(F.array_join(found, "/"), F.lit("")) if joined else found


def ownership(foreign: Column, private: Column, independent: Column, known: Column) -> Column:  # I-43
    return F.when(foreign, "中外合作办学").when(F.coalesce(private, F.lit(False)) | F.coalesce(independent, F.lit(False)), "民办").when(known.isNotNull(), "公办")


def strength_label(evidence: Column, tier: Column) -> Column:  # I-44; evidence: array of structs with signal_type and signal_level
    named = F.transform(evidence, lambda e: F.when((e.signal_type == "first_class_major") & (e.signal_level == "national"), "国一").when((e.signal_type == "first_class_major") & (e.signal_level == "provincial"), "省一").when((e.signal_type == "featured_major") & (e.signal_level == "national"), "国特"))
    found = F.array_distinct(F.array_compact(F.coalesce(named, F.array().cast("array<string>"))))
    return F.when(F.size(found) > 0, F.array_join(found, "/")).when(tier == "national", "国一").when(tier == "provincial", "省一")


def admission_rule(content: Column | str, adjustment: Column | str) -> Column:  # I-45
    t = clean_text(content)
    return F.when(has(t, "专业志愿优先", "专业优先"), "专业优先").when(has(t, "分数优先"), "分数优先").when(has(t, "专业级差"), "专业级差").otherwise(as_text(adjustment))


def major_note(full: Column | str, canonical: Column | str, note: Column | str) -> Column:  # I-46
    f, c = clean_text(full), clean_text(canonical)
    rest = F.when((c != "") & F.startswith(f, c), F.trim(F.substr(f, F.length(c) + 1)))
    return F.nullif(F.array_join(F.array_distinct(F.array_compact(F.array(F.nullif(rest, F.lit("")), as_text(note)))), "；"), F.lit(""))


def strip_query(url: Column | str) -> Column:  # I-47
    return F.regexp_replace(_c(url), "[?#].*$", "")


def url_code(url: Column | str, key: str) -> Column:  # I-48: from the query, else from the path
    return F.coalesce(F.try_parse_url(_c(url), F.lit("QUERY"), F.lit(key)), F.nullif(F.regexp_extract(_c(url), key + r"[-_=/]([A-Za-z0-9]+)", 1), F.lit("")))


def cut(x: Column | str, n: int) -> Column:  # I-63
    return F.left(_c(x), F.lit(n))


def safe(x: Column | str, kind: str) -> Column:  # I-65
    return F.trim(_c(x).cast("string")).try_cast(kind)


def json_array(x: Column | str, schema: str) -> Column:  # I-64: fences go, what isn't a list is an empty one
    bare = F.trim(F.regexp_replace(F.coalesce(_c(x), F.lit("")), r"(?m)^\s*```[A-Za-z]*\s*$", ""))
    return F.when(F.startswith(bare, F.lit("[")), F.from_json(bare, f"array<{schema}>")).otherwise(F.array().cast(f"array<{schema}>"))


def labelled(x: Column | str, label: str) -> Column:  # I-31
    return F.nullif(F.trim(F.regexp_extract(_c(x), label + r"\s*[:：]\s*([^\n。.]+)", 1)), F.lit(""))


def items(x: Column | str) -> Column:  # I-32
    return F.filter(F.transform(F.split(_c(x), "[、,，;；]"), lambda p: F.trim(p)), lambda p: p != "")


def js_string(x: Column | str, key: str) -> Column:  # I-28
    return F.nullif(F.regexp_extract(_c(x), key + r"""\s*[:=]\s*["']((?:\\.|[^"'\\])*)["']""", 1), F.lit(""))


def paragraphs(html: Column | str) -> Column:  # I-30
    from siftwell.functions.security import unescape

    t = unescape(F.regexp_replace(F.regexp_replace(_c(html), r"(?i)</p\s*>|<br\s*/?>", "\n"), "<[^>]+>", ""))
    return F.array_join(F.filter(F.transform(F.split(t, "\n"), lambda p: F.trim(F.regexp_replace(p, SPACE, " "))), lambda p: p != ""), "\n")
