"""Families of sites, as selectors and refinements of html.extract; a site is a row of such settings."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from factloom.sources import html


@dataclass(frozen=True)
class Site:
    fields: dict[str, str]
    steps: tuple = ()
    least_bio: int = 0

    def refine(self, row: dict) -> dict | None:
        for step in self.steps:
            row = step(row)
            if row is None:
                return None
        return row if len(row.get("bio") or "") >= self.least_bio else None

    def items(self, pages: DataFrame) -> DataFrame:
        return html.extract(pages, self.fields, self.refine)


def title_tail(row: dict) -> dict:
    """A/B/Name to Name."""
    return row | {"name": (row.get("name") or "").split("/")[-1].strip() or None}


def no_appendix(row: dict) -> dict | None:
    return None if "appendix" in (row.get("name") or "").lower() else row


def year_pair(row: dict) -> dict:
    """birth and death from the first 1820-1890 in the text."""
    m = re.search(r"\b(\d{4})\D(\d{4})\b", row.get("bio") or "")
    return row | ({"birth": m[1], "death": m[2]} if m else {})


def without_suffix(*suffixes: str):  # noqa: ANN201
    def step(row: dict) -> dict:
        name = row.get("name") or ""
        for s in suffixes:
            name = name.removesuffix(s)
        return row | {"name": name.strip() or None}

    return step


def short_end_year(row: dict) -> dict:
    """1515-35: the end takes the century of the start."""
    m = re.search(r"\b(\d{2})(\d{2})\s*-\s*(\d{2})\b(?!\d)", row.get("bio") or "")
    return row | ({"birth": m[1] + m[2], "death": m[1] + m[3]} if m else {})


def key_values(keys: list[str], values: list[str]) -> dict[str, str]:
    """Keys in lower case without colons, zipped with values; the last of a key stays."""
    return {k.strip().lower().rstrip(":"): v.strip() for k, v in zip(keys, values, strict=False)}


#: A line that begins a person's entry: a name, and years that may be missing or before Christ.
YEARS = re.compile(r"^\s*(?P<name>[^()\d]+?)\s*\((?P<bc>b\.?\s*c\.?)?\s*(?P<birth>\d{1,4})?\s*[-–]\s*(?P<death>\d{1,4})?\s*(?P<bc2>b\.?\s*c\.?)?\)", re.IGNORECASE)


def header_years(line: str) -> dict | None:
    """name, birth and death of a header line; years before Christ are negative; None for other lines."""
    m = YEARS.match(line)
    if not m:
        return None
    sign = -1 if m["bc"] or m["bc2"] else 1
    return {"name": m["name"].strip(" .,"), "birth": str(sign * int(m["birth"])) if m["birth"] else None, "death": str(sign * int(m["death"])) if m["death"] else None}


def many(page: str, header: str) -> list[dict]:
    """Items of a page on which headers begin them: name and the text up to the next header."""
    parts = re.split(rf"(<{header}[^>]*>.*?</{header}>)", page, flags=re.S)
    strip = lambda s: re.sub(r"\s+", " ", re.sub(r"<[^>]+>", "", s)).strip()
    return [{"name": strip(parts[i]), "bio": strip(parts[i + 1])} for i in range(1, len(parts) - 1, 2)]


_WIKI = {"name": "h1", "bio": "article p"}
SITES: dict[str, Site] = {
    "plain": Site(_WIKI), "encyclopedia": Site(_WIKI, (title_tail, no_appendix)), "dictionary": Site(_WIKI, (title_tail, year_pair), 5), "gallery": Site(_WIKI, (short_end_year,)),
    "members": Site(_WIKI, (without_suffix(" MP", "†"),)), "museum": Site({"name": "h1", "bio": "div.content p", "other": "table td"}),
}


def crawled(pages: DataFrame, site: str) -> DataFrame:
    """Items of stored pages of a family; fetching pages is not this library's."""
    return SITES[site].items(pages)


@dataclass
class Frontier:
    """Sites to do, without those done."""

    known: set[str] = field(default_factory=lambda: set(SITES))

    def left(self, done: set[str]) -> set[str]:
        return self.known - done
