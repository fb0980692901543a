"""Partial dates: formatting, parsing, and finding numeric expressions in text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_NUMBER = {m: i for i, m in enumerate(MONTHS, 1)} | {m[:3]: i for i, m in enumerate(MONTHS, 1)} | {"sept": 9}
PART = "struct<year:int,month:int,day:int>"
NORMALIZED = f"array<struct<start:int,end:int,category:string,time:{PART},from:{PART},until:{PART}>>"


def format_date(year: Column, month: Column, day: Column) -> Column:
    """Sign and 11 digits of year, month, day and precision (9 year, 10 month, 11 day). Null without any part, for a day without a
    month beside a year, and for a month or day that isn't positive; a month and day without a year have year 0."""
    bad = (year.isNull() & month.isNull() & day.isNull()) | (day.isNotNull() & month.isNull()) | (month <= 0) | (day <= 0)
    precision = F.when(day.isNotNull(), 11).when(month.isNotNull(), 10).otherwise(9)
    text = F.format_string("%+012d-%02d-%02dT00:00:00Z/%d", F.coalesce(year, F.lit(0)), F.coalesce(month, F.lit(0)), F.coalesce(day, F.lit(0)), precision)
    return F.when(~F.coalesce(bad, F.lit(False)), text)


def parse_date(text: Column | str) -> Column:
    """The parts that the precision of a formatted date covers; without a precision all."""
    pick = lambda g: F.nullif(F.regexp_extract(text, r"^([+-]\d+)-(\d\d)-(\d\d)T00:00:00Z(?:/(\d+))?$", g), F.lit("")).cast("int")
    precision = F.coalesce(pick(4), F.lit(11))
    return F.when(pick(1).isNotNull(), F.struct(pick(1).alias("year"), F.when(precision >= 10, pick(2)).alias("month"), F.when(precision >= 11, pick(3)).alias("day")))


def lenient_date(text: str) -> dict | None:
    """Day, month and year of common written forms, as far as they are there; b.c. years are negative."""
    t = text.strip().lower()
    m = re.match(r"(?:b\.?c\.?\s*(\d+)|(\d+)\s*b\.?c\.?)$", t)
    if m:
        return {"year": -int(m[1] or m[2])}
    m = re.match(r"(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})$", t)
    if m and 1 <= int(m[2]) <= 12:
        return {"year": int(m[3]), "month": int(m[2]), "day": int(m[1])}
    m = re.match(r"(\d{4})-(\d{1,2})(?:-(\d{1,2}))?$", t)
    if m:
        return {k: int(v) for k, v in zip(("year", "month", "day"), m.groups(), strict=True) if v}
    found = normalize_all(t)
    for _, _, category, value in found:
        if category == "Time":
            return value
    m = re.match(r"(\d{4})", t)
    return {"year": int(m[1])} if m else None


def lenient(text: Column) -> Column:
    """lenient_date of a column: year, month and day as far as they are there, by Arrow batches; null without any."""

    def parsed(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            found = [(lenient_date(t) if t else None) or {} for t in s]
            yield pd.DataFrame({k: pd.array([f.get(k) for f in found], dtype="Int32") for k in ("year", "month", "day")})

    return F.pandas_udf(parsed, PART)(text)


@dataclass(frozen=True)
class Rule:
    category: str
    pattern: re.Pattern
    priority: int
    needs: tuple[str, ...]

    def value(self, m: re.Match) -> dict:
        g = {k: v for k, v in m.groupdict().items() if v}
        if self.category == "Time":
            out = {}
            if "year" in g:
                out["year"] = int(g["year"])
            if "month" in g:
                out["month"] = _NUMBER[g["month"].casefold()]
            if "day" in g:
                out["day"] = int(g["day"])
            return out
        out = {}
        if "first" in g:
            out["start"] = {"year": int(g["first"])}
        if "last" in g:
            out["end"] = {"year": int(g["last"])}
        if "whole" in g:
            out = {"start": {"year": int(g["whole"])}, "end": {"year": int(g["whole"]) + (9 if "decade" in g else 1)}}
        return out


_MONTH = "(?P<month>" + "|".join(sorted(_NUMBER, key=len, reverse=True)) + r")\b"
_DIGIT = re.compile(r"\d")
_ADVERB = r"(?:(?:the\s*)?(?:early|late|mid)\s*-?\s*)?"
_Y = r"\d{4}"
_CUES = tuple(m[:3] for m in MONTHS)
#: Fixed rules in order of priority; nothing is evaluated at run time.
RULES = tuple(
    Rule(c, re.compile(p, re.IGNORECASE), i, needs)
    for i, (c, p, *needs) in enumerate([
        ("Duration", rf"\bfrom\s*(?P<first>{_Y})\s*(?:to|until|till|-)\s*(?P<last>{_Y})\b", "from"),
        ("Duration", rf"\bbetween\s*(?P<first>{_Y})\s*and\s*(?P<last>{_Y})\b", "between"),
        ("Duration", rf"\bduring\s*(?:the\s*)?{_ADVERB}(?P<whole>{_Y})(?P<decade>\s*-?\s*s)?\b", "during"),
        ("Duration", rf"\b(?:until|till)\s*(?P<last>{_Y})\b", "until", "till"),
        ("Duration", rf"\b(?:began\s*in|started\s*in|from|since)\s*{_ADVERB}(?P<first>{_Y})s?\b", "began", "started", "from", "since"),
        ("Time", rf"\b(?:in|by)\s*{_ADVERB}(?:{_MONTH}\s*)?(?P<year>{_Y})\b", "in", "by"),
        ("Time", rf"\b(?P<day>[0-3]?\d)\s*(?:st|nd|rd|th)?\s*(?:of\s*)?{_MONTH}(?:\s*,?\s*(?P<year>{_Y})\b)?", *_CUES),
        ("Time", rf"\b{_MONTH}\s*(?P<year>{_Y})\b", *_CUES),
        ("Time", rf"\b{_MONTH}\s*(?P<day>[0-3]?\d)(?!\d)\s*(?:st|nd|rd|th)?(?:\s*,?\s*(?P<year>{_Y})\b)?", *_CUES),
        ("Time", rf"(?:\b(?:on|about|the|of|circa|around|year)\b|\bc\.)\s*{_ADVERB}(?P<year>{_Y})\b", "on", "about", "the", "of", "circa", "around", "year", "c."),
    ])
)


def normalize_all(text: str) -> list[tuple[int, int, str, dict]]:
    """(start, end, category, value) of all expressions: leftmost first, of those the longest, of those the first rule; none overlap."""
    if not _DIGIT.search(text):  # every rule has a number
        return []
    # Rules whose words aren't there are passed over. Positions are those of the text itself: its lower-case form can be longer.
    low = text.casefold()
    rules = [r for r in RULES if any(n in low for n in r.needs)]
    found = sorted(((m.start(), -m.end(), r.priority, r, m) for r in rules for m in r.pattern.finditer(text)), key=lambda x: x[:3])
    out, floor = [], 0
    for a, z, _, rule, m in found:
        if a >= floor:
            value = rule.value(m)
            if value:
                out.append((a, -z, rule.category, value))
                floor = -z
    return out


def normalize_one(text: str, mode: str = "longest") -> tuple[tuple[int, int], str | None, dict | None]:
    """One expression of a text: the longest, the shortest or the first."""
    found = normalize_all(text)
    if not found:
        return (-1, -1), None, None
    key = {"longest": lambda x: (x[0] - x[1], x[0]), "shortest": lambda x: (x[1] - x[0], x[0]), "first": lambda x: (x[0],)}[mode]
    a, z, category, value = min(found, key=key)
    return (a, z), category, value


def _normalize(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    part = lambda v: None if v is None else {k: v.get(k) for k in ("year", "month", "day")}
    for s in texts:
        yield s.map(lambda t: [] if t is None else [
            {"start": a, "end": z, "category": c, "time": part(v) if c == "Time" else None, "from": part(v.get("start")) if c != "Time" else None, "until": part(v.get("end")) if c != "Time" else None}
            for a, z, c, v in normalize_all(t)
        ])


def normalize(text: Column | str) -> Column:
    """Numeric expressions of a text as an array of structs, by Arrow batches: no JVM expression has leftmost-longest rules with values."""
    return F.pandas_udf(_normalize, NORMALIZED)(text)
