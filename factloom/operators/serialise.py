"""Labelled sentences to statements: subjects, values, qualifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from factloom.functions.dates import format_date
from factloom.functions.filters import type_class
from factloom.functions.text import fix_name
from factloom.operators import kb, statements
from factloom.operators.frames import compatible
from factloom.session import sized

#: The value of a chunk that nothing resolves.
UNKNOWN = "Q19798648"


def mapping(lexicon: DataFrame) -> DataFrame:
    """lu, fe to property, core, types and qualifiers: what a unit's elements are in statements; elements without a property are left out."""
    keys = lexicon.where("property is not null").groupBy(F.element_at(F.split("lu", r"\."), 1).alias("lu"), "fe")
    return keys.agg(F.max("property").alias("property"), F.max("core").alias("core"), F.collect_set("class").alias("fe_types"), F.flatten(F.collect_set(F.coalesce("qualifiers", F.array().cast("array<string>")))).alias("fe_qualifiers"))


def _date(part: Column) -> Column:
    return format_date(part["year"], part["month"], part["day"])


def qualifier_values(rows: DataFrame) -> DataFrame:
    """id and its qualifiers as (property, value), in the order of the elements: Time P585, start P580, end P582, Place P276 by its page."""
    fe = F.col("fe")
    pair = lambda p, v: F.struct(F.lit(p).alias("property"), v.alias("value"))
    every = F.when(fe["fe"] == "Time", F.array(pair("P585", _date(fe["time"])))).when(fe["fe"] == "Duration", F.array(pair("P580", _date(fe["from"])), pair("P582", _date(fe["until"])))).when(fe["fe"] == "Place", F.array(pair("P276", F.col("page_id"))))
    each = rows.select("id", "fe_no", F.posexplode(every).alias("k", "q")).where("q.value is not null")
    return each.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("fe_no", "k", "q"))), lambda x: x["q"]).alias("qualifiers"))


def first_hits(names: DataFrame) -> DataFrame:
    """name in lower case and the least id that has it."""
    return names.groupBy(F.lower("label").alias("_name")).agg(F.min("id").alias("subject"))


def serialise(labelled: DataFrame, lexicon: DataFrame, names: DataFrame, pages: DataFrame, known_urls: DataFrame, values: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Statements (id, statement) of labelled sentences, and subjects that could not be resolved (id, chunk, text, url).

    Subjects are the core elements of the sentence, found by name; a sentence without any is about the page's subject: that of its url in known_urls (url, subject),
    else the person of its name. Every other element becomes statements: dates of Time and Duration, else the page of its link, its resolver's value, or
    UNKNOWN; elements without a property, or whose types don't go with the link's, give none. Qualifiers are those that the element declares.
    names (label, id) of people; pages (title, id); values (property, value, id): what resolvers know.
    """
    rows = labelled.select("id", "lu", "name", "url", "text", F.posexplode("fes").alias("fe_no", "fe"))
    rows = _mapped(rows, lexicon)
    rows = kb.items_of_urls(rows.withColumn("link", F.col("fe.uri")), sized(pages.select("title", F.col("id").alias("page_id"))), "link").drop("link", "title")
    known = sized(first_hits(names), of=names)
    core = rows.where(F.coalesce("core", F.lit(False))).select("id", F.col("fe.chunk").alias("chunk")).distinct()
    core = core.withColumn("_name", fix_name("chunk")).join(known, "_name", "left").select("id", "chunk", "subject")
    other = labelled.select("id", "name", "url").join(core.select("id").distinct(), "id", "left_anti").join(sized(known_urls.select("url", F.col("subject").alias("_known"))), "url", "left")
    other = other.withColumn("_name", fix_name("name")).join(known, "_name", "left")
    other = other.select("id", F.when(F.col("_known").isNull(), F.col("name")).alias("chunk"), F.coalesce("_known", "subject").alias("subject"))
    subjects = core.unionByName(other)
    missing = subjects.where("subject is null").join(labelled.select("id", "text", "url"), "id").select("id", "chunk", "text", "url")

    each = rows.join(subjects.where("subject is not null").withColumnRenamed("chunk", "_own"), "id").where("property is not null").where(~F.col("fe.chunk").eqNullSafe(F.col("_own")))
    numeric = F.col("fe.fe").isin("Time", "Duration")
    dates = F.when(F.col("fe.fe") == "Time", F.array(_date(F.col("fe.time")))).otherwise(F.array(_date(F.col("fe.from")), _date(F.col("fe.until"))))
    dated = each.where(numeric).select("id", "subject", "property", "url", F.explode(F.array_compact(dates)).alias("value"), F.array().cast("array<string>").alias("more"))
    linked = each.where(~numeric).where(compatible(F.coalesce("fe_types", F.array().cast("array<string>")), F.coalesce(F.transform("fe.types", lambda t: type_class(t)), F.array().cast("array<string>"))))
    linked = linked.join(qualifier_values(rows), "id", "left")
    if values is not None:
        looked = values.groupBy("property", F.lower("value").alias("_value")).agg(F.min("id").alias("_found"))
        linked = linked.withColumn("_value", F.lower(F.trim("fe.chunk"))).join(looked, ["property", "_value"], "left")
    else:
        linked = linked.withColumn("_found", F.lit(None).cast("string"))
    value = F.coalesce("page_id", "_found", statements.resolve(F.col("property"), F.col("fe.chunk")), F.lit(UNKNOWN))
    own = F.filter(F.coalesce("qualifiers", F.array()), lambda q: F.array_contains(F.coalesce("fe_qualifiers", F.array().cast("array<string>")), q["property"]))
    more = F.flatten(F.transform(own, lambda q: F.array(q["property"], q["value"])))
    linked = linked.select("id", "subject", "property", "url", value.alias("value"), more.alias("more"))
    out = dated.unionByName(linked)
    text = F.concat_ws("\t", "subject", "property", "value", "more", *statements.reference(F.col("url")))
    return out.select("id", text.alias("statement")), missing


def _mapped(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """rows with the property, core, types and qualifiers of their unit and element; null where there are none."""
    known = mapping(lexicon).withColumnsRenamed({"lu": "_lu", "fe": "_fe"})
    return rows.withColumns({"_lu": F.element_at(F.split("lu", r"\."), 1), "_fe": F.col("fe.fe")}).join(sized(known, of=lexicon), ["_lu", "_fe"], "left").drop("_lu", "_fe")


def url_subjects(rows: DataFrame, url: str = "url", subject: str = "subject") -> DataFrame:
    """url and subject where a url has one subject only."""
    one = rows.groupBy(url).agg(F.min(subject).alias("subject"), F.max(subject).alias("_high"))
    return one.where(F.col("subject") == F.col("_high")).select(F.col(url).alias("url"), "subject")


def profession(records: DataFrame, values: DataFrame, key: str, text: str) -> DataFrame:
    """key and id: of the parts of a text between slashes the first that exactly one thing is named by."""
    parts = records.select(key, F.posexplode(F.split(text, "/")).alias("position", "_v")).withColumn("_v", F.lower(F.trim("_v")))
    one = values.groupBy(F.lower("value").alias("_v")).agg(F.count("*").alias("_n"), F.min("id").alias("id")).where("_n = 1")
    met = parts.join(one, "_v")
    return met.withColumn("_k", F.row_number().over(W.partitionBy(key).orderBy("position"))).where("_k = 1").select(key, "id")
