"""Scalar text functions as columns: all run in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_WORD = r"[^\p{L}\p{N}]+"
HONORIFICS = ("professor", "prof", "mister", "misses", "missus", "mrs", "mr", "ms", "sir", "lady", "lord", "dame", "rev", "dr")


def tokens(text: Column | str, lower: bool = False) -> Column:
    """Runs of letters and numbers."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(text) if lower else text, NOT_WORD), lambda x: x != "")


def sentences(text: Column | str) -> Column:
    """Lines, cut after . ! or ? before white space; trimmed, empty ones dropped."""
    parts = F.split(F.regexp_replace(text, r"([.!?])\s+", "$1\n"), "\n")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


#: What may stand before a dot inside a sentence, by language; initials may in all of them.
ABBREVIATIONS = {
    "en": "mr mrs ms dr prof rev hon st jr sr vs etc e.g i.e no vol pp fig capt col gen lt sgt inc ltd co", "de": "dr prof hr fr z.b d.h u.a bzw usw ca nr st bd s vgl", "fr": "m mm mme mlle dr pr etc p ex cf av apr no st ste",
    "es": "sr sra srta dr dra prof etc p.ej ud uds núm av", "it": "sig dott prof ing avv ecc es n pag s vol", "nl": "dr prof dhr mevr bijv enz nr ca", "pt": "sr sra dr dra prof etc p.ex nº av", "da": "dr hr fr f.eks osv nr ca", "sv": "dr hr fr t.ex osv nr ca", "no": "dr hr fr f.eks osv nr ca",
    "fi": "esim mm ym jne nro", "pl": "dr prof np itd itp nr ul", "cs": "dr prof např atd č ul", "sl": "dr prof npr itd št", "et": "dr prof nt jne nr", "el": "κ κα δρ π.χ κ.λπ", "tr": "dr prof vb vs no sn",
}


def language_sentences(text: Column | str, lang: str = "en") -> Column:
    """Lines, cut after . ! or ? and closing quotes before white space, but not after an initial or an abbreviation of the language; trimmed, empty ones dropped. Languages
    without a list know initials only."""
    short = "|".join(re.escape(a) for a in ABBREVIATIONS.get(lang, "").split())
    held = rf"(?<!(?<![\p{{L}}.])(?i:{short}))" if short else ""
    close = r"[\"'»”’)\]]*"
    cut = rf"(?<!(?<![\p{{L}}])\p{{Lu}}){held}(\.{close})\s+|((?:[!?]|\.\.){close})\s+"
    parts = F.split(F.regexp_replace(text, cut, "$1$2\n"), "\n")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def token_sentences(words: Column) -> Column:
    """Tokens in runs that end with a token . ! or ?; what is left at the end is one too."""
    ends = F.filter(F.transform(words, lambda x, i: F.when(x.isin(".", "!", "?"), i + 1)), lambda i: i.isNotNull())
    ends = F.concat(F.array(F.lit(0)), ends, F.when(F.coalesce(F.array_max(ends), F.lit(0)) < F.size(words), F.array(F.size(words))).otherwise(F.array().cast("array<int>")))
    runs = F.transform(F.sequence(F.lit(1), F.size(ends) - 1), lambda k: F.slice(words, F.element_at(ends, k) + 1, F.element_at(ends, k + 1) - F.element_at(ends, k)))
    return F.when(F.size(words) > 0, runs).otherwise(F.array().cast("array<array<string>>"))


def spaced(name: Column | str) -> Column:
    """Underscores as spaces."""
    return F.replace(F.col(name) if isinstance(name, str) else name, F.lit("_"), F.lit(" "))


def clean_whitespace(text: Column | str) -> Column:
    """Runs of two or more white-space characters become the last of them; the ends are trimmed."""
    return F.regexp_replace(F.regexp_replace(text, r"(?:\s){1,}(\s)", "$1"), r"^\s+|\s+$", "")


def host(url: Column | str) -> Column:
    """What stands between // and the path: with port and user, in lower case as given."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def last_segment(path: Column | str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def strip_tags(html: Column | str) -> Column:
    return F.regexp_replace(html, "<[^>]+>", "")


def title_case(name: Column | str) -> Column:
    """A capital after everything that isn't a letter: O'Neil, Jean-Luc."""
    name = F.col(name) if isinstance(name, str) else name
    pieces = F.regexp_extract_all(F.lower(name), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(pieces, F.initcap), "")


def strip_honorifics(name: Column | str) -> Column:
    """Leading titles, each a whole word with or without a dot, as many as there are."""
    return F.regexp_replace(F.trim(name), r"(?i)^(?:(?:" + "|".join(HONORIFICS) + r")\b\.?\s*)+", "")


def fix_name(name: Column | str) -> Column:
    """Lower case without brackets and titles; "Last, First ..." becomes "first last"; of more than two words the first and last stay."""
    name = F.col(name) if isinstance(name, str) else name
    bare = F.trim(F.regexp_replace(F.lower(name), r"\([^)]*\)", ""))
    comma = F.split(bare, r"\s*,\s*", 2)
    given = F.element_at(F.split(strip_honorifics(F.element_at(comma, 2)), r"\s+"), 1)
    joined = F.when(F.size(comma) > 1, F.concat_ws(" ", given, F.element_at(comma, 1))).otherwise(bare)
    words = F.split(strip_honorifics(joined), r"\s+")
    return F.when(F.size(words) > 2, F.concat_ws(" ", F.element_at(words, 1), F.element_at(words, -1))).otherwise(F.array_join(words, " "))


def birth_death(text: Column | str) -> Column:
    """struct(birth, death) of forms like 1820-1890, b. 1820, d.1890, c. 1820 - ca. 1890, 1820-?; absent parts are null."""
    text = F.col(text) if isinstance(text, str) else text
    flat = F.regexp_replace(F.regexp_replace(F.lower(text), r"\s+", ""), "–", "-")
    year = r"(?:ca?\.)?(\d{4}|\d{1,2}thcentury)?\??"
    pick = lambda pattern, g=1: F.nullif(F.regexp_extract(flat, pattern, g), F.lit(""))
    pair = "^" + year + "-" + year + "$"
    birth = F.coalesce(pick(r"^b\.(?:ca?\.)?(\d{4})\??$"), pick(pair, 1))
    death = F.coalesce(pick(r"^d\.(?:ca?\.)?(\d{4})\??$"), pick(pair, 2))
    return F.struct(birth.alias("birth"), death.alias("death"))


def complete_year(start: Column, end: Column) -> Column:
    """1515-35: a two-digit end takes the century of the start."""
    return F.when(F.length(end) == 2, F.concat(F.substring(start, 1, 2), end)).otherwise(end)


def zip_map(keys: Column, values: Column) -> Column:
    """A map of keys to values, as long as the shorter; of a key that comes twice the last value stays."""
    n = F.least(F.size(keys), F.size(values))
    pairs = F.arrays_zip(F.slice(keys, 1, n).alias("k"), F.slice(values, 1, n).alias("v"))
    last = F.filter(F.transform(pairs, lambda p, i: F.struct(p["k"].alias("k"), p["v"].alias("v"), i.alias("i"))), lambda p: p["i"] + 1 == n - F.array_position(F.reverse(F.slice(keys, 1, n)), p["k"]) + 1)
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["k"], p["v"])))


def literal(value: Column, lang: str) -> Column:
    return F.concat(F.lit(f'{lang}:"'), F.replace(value, F.lit('"'), F.lit('\\"')), F.lit('"'))
