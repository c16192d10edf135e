"""Dates, time ranges and year scopes (I-25 to I-27, C-15, I-68)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwell.functions.text import _c, clean_text

FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy/MM/dd", "yyyy年MM月dd日"]


def any_date(x: Column | str, formats: list[str] = FORMATS) -> Column:  # I-25
    return F.coalesce(*[F.try_to_timestamp(F.trim(_c(x)), F.lit(f)) for f in formats])


def time_range(x: Column | str, year: Column) -> Column:  # I-26: struct(start, end), both null if either is not a time
    t, part = clean_text(x), r"(?:([0-9]{4})年)?(?:([0-9]{1,2})月([0-9]{1,2})日?|([0-9]{1,2})日)?([0-9]{1,2})(?::([0-9]{1,2}))?"
    whole = r"(?:([0-9]{4})年)?([0-9]{1,2})月([0-9]{1,2})日?([0-9]{1,2})(?::([0-9]{1,2}))?(?:至|到|-|—|－|~|～)" + part
    g = lambda i: F.nullif(F.regexp_extract(t, whole, i), F.lit("")).try_cast("int")
    y, m, d = F.coalesce(g(1), year.cast("int")), g(2), g(3)
    zero = F.lit(0)
    start = F.try_make_timestamp(y, m, d, g(4), F.coalesce(g(5), zero), F.lit(0).cast("decimal(8,6)"))
    end = F.try_make_timestamp(F.coalesce(g(6), y), F.coalesce(g(7), m), F.coalesce(g(8), g(9), d), g(10), F.coalesce(g(11), zero), F.lit(0).cast("decimal(8,6)"))
    ok = start.isNotNull() & end.isNotNull()
    return F.struct(F.when(ok, start).alias("start"), F.when(ok, end).alias("end"))


def registration_window(x: Column | str) -> Column:  # I-27: struct(start, end)
    t = clean_text(x)
    cn = r"([0-9]{4})年([0-9]{1,2})月([0-9]{1,2})日.*?(?:至|到|-|—|~).*?(?:([0-9]{4})年)?([0-9]{1,2})月([0-9]{1,2})日"
    iso = r"([0-9]{4}-[0-9]{2}-[0-9]{2}).*?(?:至|到|—|~).*?([0-9]{4}-[0-9]{2}-[0-9]{2})"
    g = lambda p, i: F.nullif(F.regexp_extract(t, p, i), F.lit(""))
    day = lambda y, m, d: F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    start = F.coalesce(F.when(g(cn, 1).isNotNull(), day(g(cn, 1), g(cn, 2), g(cn, 3))), F.try_to_date(g(iso, 1), "yyyy-MM-dd"))
    end = F.coalesce(F.when(g(cn, 5).isNotNull(), day(F.coalesce(g(cn, 4), g(cn, 1)), g(cn, 5), g(cn, 6))), F.try_to_date(g(iso, 2), "yyyy-MM-dd"))
    return F.struct(start.alias("start"), end.alias("end"))


def year_scope(mode: str, today: dt.date, first: int = 2000, start: int | None = None, end: int | None = None) -> list[int]:
    """C-15: all years or the last three, within an explicit window."""
    low, high = (today.year - 2, today.year) if mode == "incremental" else (first, today.year)
    return list(range(max(low, start or low), min(high, end or high) + 1))


def completed_years(today: dt.date, n: int = 3) -> list[int]:
    """M-23: the last n whole years; December counts its own year."""
    last = today.year if today.month == 12 else today.year - 1
    return list(range(last - n + 1, last + 1))


def normalize_years(years: list[int] | None, today: dt.date) -> list[int]:
    return sorted(set(years)) if years else completed_years(today)


_NAMES = {n: i for i, n in enumerate(("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"), 1)} | {n: i for i, n in enumerate(("sun", "mon", "tue", "wed", "thu", "fri", "sat"))}
_BOUNDS = [(0, 59), (0, 23), (1, 31), (1, 12), (0, 7)]


def cron_fields(expression: str) -> list[set[int]]:
    """I-68: the values that each of five fields allows: lists, ranges, steps, names."""
    parts = expression.split()
    if len(parts) != 5:
        raise ValueError("a cron expression has five fields")
    number = lambda s: _NAMES.get(s.lower()) if s.lower() in _NAMES else int(s)
    out = []
    for part, (low, high) in zip(parts, _BOUNDS):
        allowed: set[int] = set()
        for item in part.split(","):
            span, _, step = item.partition("/")
            a, _, b = span.partition("-")
            first, last = (low, high) if span == "*" else (number(a), number(b) if b else high if step else number(a))
            if not low <= first <= last <= high or step and int(step) < 1:
                raise ValueError(f"out of range: {item}")
            allowed |= set(range(first, last + 1, int(step or 1)))
        out.append({x % 7 for x in allowed} if high == 7 else allowed)
    return out


def cron_matches(expression: str, at: dt.datetime) -> bool:
    minute, hour, day, month, weekday = cron_fields(expression)
    _, _, d, _, w = expression.split()
    days, week = at.day in day, at.isoweekday() % 7 in weekday
    either = days or week if d != "*" and w != "*" else days and week
    return at.minute in minute and at.hour in hour and at.month in month and either
