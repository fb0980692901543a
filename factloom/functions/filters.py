"""Predicates of the engine, as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC_ELEMENTS = ("Duration", "Frequency", "Time")
PLACE = "http://dbpedia.org/ontology/Place"


def has_document(text: str, least: int = 50) -> Column:
    return F.coalesce(F.length(text) > least, F.lit(False))


def has_name_and_url(name: str = "name", url: str = "url") -> Column:
    return F.coalesce((F.trim(name) != "") & (F.trim(url) != ""), F.lit(False))


def sourced(url: str = "url", allow_unsourced: bool = False) -> Column:
    return F.lit(True) if allow_unsourced else F.coalesce(F.col(url) != "", F.lit(False))


def is_verb(pos: Column, lang: str = "en") -> Column:
    return pos.startswith("VER" if lang == "it" else "V")


def without_places(entities: Column) -> Column:
    """Linked entities that aren't places."""
    return F.filter(entities, lambda e: ~F.coalesce(F.array_contains(e["types"], PLACE), F.lit(False)))


def not_numeric(element: Column) -> Column:
    return ~element.isin(*NUMERIC_ELEMENTS)


def confident(confidence: Column, least: float = 0.25) -> Column:
    return confidence >= least


def past_year(year: Column, now: Column | None = None) -> Column:
    """The year, or null where it is still to come."""
    return F.when(year <= (F.year(F.current_date()) if now is None else now), year)


def known_fields(fields: Column, names: Sequence[str]) -> Column:
    """Of a map the wanted fields, with tidy keys: trimmed, lower case, without a colon."""
    tidy = F.transform_keys(fields, lambda k, _: F.regexp_replace(F.lower(F.trim(k)), ":$", ""))
    return F.map_filter(tidy, lambda k, _: k.isin(*names))


def short(sentence: Column, least: int = 5) -> Column:
    return F.length(sentence) < least


def semicolon_list(text: Column, drop: Sequence[str] = ()) -> Column:
    return F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: (x != "") & ~F.lower(x).isin(*[d.lower() for d in drop] or [""]))


def type_class(uri: Column, prefix: str = "http://dbpedia.org/ontology/") -> Column:
    return F.when(uri.startswith(prefix), F.substr(uri, F.lit(len(prefix) + 1))).otherwise(uri)


def union_all(*tables: DataFrame) -> DataFrame:
    """Rows of all tables, with null where one has no such column."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
