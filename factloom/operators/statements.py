"""Statements about subjects, from labelled sentences and semi-structured records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from factloom.functions.dates import format_date, lenient, parse_date
from factloom.functions.text import literal, title_case
from factloom.session import sized

Resolver = Callable[[Column], Column]
_RESOLVERS: dict[str, Resolver] = {}


def resolver(*properties: str) -> Callable[[Resolver], Resolver]:
    """Register a column builder for properties; the last one registered counts."""

    def add(f: Resolver) -> Resolver:
        for p in properties:
            _RESOLVERS[p] = f
        return f

    return add


@resolver("P509", "P734", "P742", "P735", "P1559")
def as_literal(value: Column) -> Column:
    return literal(value, "en")


@resolver("P21")
def gender(value: Column) -> Column:
    v = F.lower(F.trim(value))
    return F.when(v.isin("male", "m", "man"), "Q6581097").when(v.isin("female", "f", "woman"), "Q6581072")


_NUMERIC = r"^(\d{4})(?:-(\d{1,2}))?(?:-(\d{1,2}))?$"


def _bare(value: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(value), r"\((?:circa|probable|presumed)\)|c\.", ""))


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def numeric_date(value: Column) -> Column:
    """A date in numbers, without Python; null for other forms."""
    part = lambda p, i: F.get(p, F.lit(i)).cast("int")
    dated = lambda b: F.when(b.rlike(_NUMERIC), _once(F.split(b, "-"), lambda p: format_date(part(p, 0), part(p, 1), part(p, 2))))
    return _once(_bare(value), dated)


@resolver("P569", "P570")
def date(value: Column) -> Column:
    numeric = _bare(value).rlike(_NUMERIC)
    other = lenient(F.when(~numeric, _bare(value)))
    return F.when(numeric, numeric_date(value)).otherwise(format_date(other["year"], other["month"], other["day"]))


_TITLES = {
    "Q209690": "sir", "Q177053": "mr mister", "Q313549": "mrs", "Q13359947": "miss", "Q42603": "rev", "Q43115": "st", "Q611644": "bishop archbishop", "Q4618975": "phd dr", "Q2746176": "hon", "Q121594": "prof",
}
HONORIFICS = {word: item for item, words in _TITLES.items() for word in words.split()}


@resolver("P1035")
def honorific(value: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in HONORIFICS.items() for x in kv])[F.regexp_replace(F.lower(F.trim(value)), r"\.$", "")]


#: Types that a thing may have to be the value of a property that is searched for by name.
PLACES = {"P19": ("city", "country"), "P20": ("city", "country"), "P1444": ("city", "country"), "P27": ("country",), "P106": ("profession",)}


def searched(rows: DataFrame, things: DataFrame, nationalities: DataFrame) -> DataFrame:
    """property, value and id of distinct rows (property, value) whose property is one of PLACES, as far as things (label, id, type) name them: a nationality by its country
    (adjective, country), a profession by the first of its parts between slashes that exactly one thing has, others by the least id."""
    want = rows.select("property", "value").where(F.col("property").isin(*PLACES) & F.col("value").isNotNull()).distinct()
    each = want.select("property", "value", F.posexplode(F.when(F.col("property") == "P106", F.split("value", "/")).otherwise(F.array("value"))).alias("part", "term"))
    known = nationalities.groupBy(F.lower("adjective").alias("term")).agg(F.min("country").alias("country"))
    each = each.withColumn("term", F.lower(F.trim("term"))).join(known, "term", "left")
    each = each.withColumn("term", F.when(F.col("property") == "P27", F.lower("country")).otherwise(F.col("term")))
    types = F.create_map(*[x for p, kinds in PLACES.items() for x in (F.lit(p), F.array(*[F.lit(k) for k in kinds]))])
    met = each.join(things.select(F.lower("label").alias("term"), "id", "type").distinct(), "term").where(F.array_contains(types[F.col("property")], F.col("type")))
    by = met.groupBy("property", "value", "part").agg(F.min("id").alias("id"), F.countDistinct("id").alias("_n")).where("property <> 'P106' or _n = 1")
    return by.groupBy("property", "value").agg(F.min_by("id", "part").alias("id"))


def resolve(property_: Column, value: Column, but: dict[str, Resolver] | None = None) -> Column:
    """The value as its property's resolver gives it, or that of `but`; null for properties without one."""
    out = F.lit(None).cast("string")
    for p, f in (_RESOLVERS | (but or {})).items():
        out = F.when(property_ == p, f(value)).otherwise(out)
    return out


def statement(subject: Column, property_: Column, value: Column, *more: Column) -> Column:
    """subject, property, value and qualifiers or references, joined by tabs; null where one of the first three is."""
    return F.when(subject.isNotNull() & property_.isNotNull() & value.isNotNull(), F.concat_ws("\t", subject, property_, value, *more))


def reference(url: Column) -> list[Column]:
    return [F.lit("S854"), F.concat(F.lit('"'), url, F.lit('"'))]


def from_fields(records: DataFrame, subject: str, fields: str, properties: DataFrame, url: str) -> tuple[DataFrame, DataFrame]:
    """Statements from a map of fields, and what could not be resolved: all mapped fields are in one of the two. properties (field, property). Dates in words are the
    only fields that Python sees; a column of it would take all fields there."""
    each = records.select(subject, url, F.explode(fields).alias("field", "chunk")).join(sized(properties), "field")
    own = [p for p in DATES if _RESOLVERS.get(p) is date]
    words = F.coalesce(F.col("property").isin(*own) & ~_bare(F.col("chunk")).rlike(_NUMERIC), F.lit(False))
    done = each.where(~words).withColumn("value", resolve(F.col("property"), F.col("chunk"), dict.fromkeys(own, numeric_date)))
    if own:
        done = done.unionByName(each.where(words).withColumn("value", date(F.col("chunk"))))
    good = done.where("value is not null").select(subject, "property", statement(F.col(subject), F.col("property"), F.col("value"), *reference(F.col(url))).alias("statement"))
    return good, done.where("value is null").select(subject, "property", "chunk", url)


def name_statement(subject: Column, name: Column) -> Column:
    return statement(subject, F.lit("P1559"), literal(title_case(name), "en"))


def qualifiers(rows: DataFrame, key: str, kind: Column, value: Column) -> DataFrame:
    """Qualifier properties of each key: Time P585, start P580, end P582, Place P276, each with its sorted values."""
    prop = F.when(kind == "Time", "P585").when(kind == "Start", "P580").when(kind == "End", "P582").when(kind == "Place", "P276")
    each = rows.select(key, prop.alias("property"), value.alias("_v")).where("property is not null and _v is not null")
    return each.groupBy(key, "property").agg(F.array_join(F.sort_array(F.collect_set("_v")), "|").alias("values"))


DATES = ("P569", "P570")


def disambiguate(people: DataFrame, claims: DataFrame, kb: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Dates are equal where all parts that both have are. A person without claims is the least entity of the name, with score 0. The candidate of each person's name with the largest weight of equal claims, at least 1; ties go to the least entity. people (person, name),
    claims (person, property, value), kb (entity, label, property, value)."""
    labels = kb.select("entity", F.lower("label").alias("_name")).distinct()
    found = people.withColumn("_name", F.lower("name")).join(labels, "_name").select("person", "entity")
    weight = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    claims, facts = claims.select("person", "property", "value").distinct(), kb.select("entity", "property", "value").distinct()
    dated = F.col("property").isin(*DATES)
    met = found.join(claims.where(~dated), "person").join(facts.where(~dated), ["entity", "property", "value"]).select("person", "entity", "property")
    a, b = parse_date("value"), parse_date("_value")
    same = F.lit(True)
    for part in ("year", "month", "day"):
        same = same & F.coalesce(a[part] == b[part], F.lit(True))
    close = found.join(claims.where(dated), "person").join(facts.where(dated).withColumnRenamed("value", "_value"), ["entity", "property"])
    met = met.unionByName(close.where(a.isNotNull() & b.isNotNull() & same).select("person", "entity", "property"))
    scored = met.groupBy("person", "entity").agg(F.sum(F.coalesce(weight[F.col("property")], F.lit(1.0))).alias("score")).where("score >= 1")
    best = scored.withColumn("_n", F.row_number().over(W.partitionBy("person").orderBy(F.desc("score"), "entity"))).where("_n = 1").drop("_n")
    alone = found.join(claims.select("person").distinct(), "person", "left_anti").groupBy("person").agg(F.min("entity").alias("entity"))
    return best.unionByName(alone.select("person", "entity", F.lit(0.0).alias("score")))


def single_hits(searches: DataFrame, key: str, position: str, hit: str) -> DataFrame:
    """Of each key's searched tokens the first with exactly one hit."""
    one = searches.groupBy(key, position).agg(F.count("*").alias("_n"), F.min(hit).alias(hit)).where("_n = 1")
    return one.groupBy(key).agg(F.min_by(hit, position).alias(hit))


def monuments(rows: DataFrame, place_property: str = "P131") -> DataFrame:
    """Monuments (id, name, place) to statements; a place's prefix com. or prov. tells its type."""
    kind = F.when(F.lower("place").startswith("com."), "Q747074").when(F.lower("place").startswith("prov."), "Q15089").otherwise(F.lit(None))
    bare = F.trim(F.regexp_replace("place", r"(?i)^(com|prov)\.\s*", ""))
    return rows.select("id", statement(F.col("id"), F.lit(place_property), literal(bare, "it"), F.lit("P31"), F.coalesce(kind, F.lit("Q486972"))).alias("statement"))
