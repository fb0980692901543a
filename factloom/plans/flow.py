"""Queries of the main flow: sentences to labelled sentences to statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import labelling, serialise
from factloom.plans.base import query
from factloom.session import spread, table, written

_ONTOLOGY = "http://dbpedia.org/ontology/"
#: lu, frame, pos, fe, core, class, property, qualifiers.
LEXICON = (
    ("meet", "Meeting", "V", "Agent", True, "Person", "P1", []), ("meet", "Meeting", "V", "Event", False, "Competition", "P2", ["P585"]), ("meet", "Meeting", "V", "Time", False, None, "P585", []),
    ("see", "Seeing", "V", "Viewer", True, "Thing", "P3", []), ("see", "Seeing", "V", "Time", False, None, "P571", []),
)
_ROWS = "(SELECT *, o_orderstatus = 'F' AS f, o_orderpriority LIKE '1%' AS m, o_orderkey % 4 = 0 AS two, year(o_orderdate) AS y FROM orders WHERE o_orderkey % 11 <> 0)"


def _lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEXICON), "lu string, frame string, pos string, fe string, core boolean, class string, property string, qualifiers array<string>")


def _sentences(spark: SparkSession, d: str) -> DataFrame:
    """Sentences made of orders, with tags and linked entities."""
    tag = lambda w, p, m: F.struct(F.lit(w).alias("word"), (p if isinstance(p, Column) else F.lit(p)).alias("pos"), (m if isinstance(m, Column) else F.lit(m)).alias("lemma"))
    priority = F.substring("o_orderpriority", 1, 1)
    link = lambda chunk, start, types: F.struct(
        F.lit(chunk).alias("chunk"), F.lit(start).alias("start"), F.lit(start + len(chunk)).alias("end"), F.lit(f"http://x/wiki/{chunk}").alias("uri"), F.lit(0.5).alias("confidence"), types.alias("types"),
    )
    classes = lambda *names: F.array(*[F.lit(_ONTOLOGY + n) for n in names])
    number = lambda c, n: (F.col(c) % n).cast("string")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("Name "), number("o_custkey", 50)).alias("name"),
        F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(F.concat(F.lit("http://h/"), number("o_custkey", 40))).alias("url"),
        F.concat(F.lit("Alice meets Bob"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" in "), F.year("o_orderdate").cast("string"))).otherwise(F.lit(""))).alias("text"),
        F.array(tag("Alice", "NP", "Alice"), tag("meets", F.when(priority == "3", "NN").otherwise(F.lit("VVZ")), F.when(priority.isin("1", "3"), "meet").otherwise(F.lit("walk"))), tag("sees", "VVZ", "see")).alias("tagged"),
        F.array(link("Alice", 0, classes("Person")), link("Bob", 12, F.when(F.col("o_orderkey") % 4 == 0, classes("Thing", "Competition")).otherwise(classes("Competition")))).alias("linked"),
    )


@query(
    f"""SELECT o_orderkey AS id, CASE WHEN m THEN 'Meeting' ELSE 'Seeing' END AS frame,
concat_ws(';', CASE WHEN f THEN 'Time:in ' || y END, CASE WHEN m AND two THEN 'Event:Bob;Agent:Alice' WHEN m THEN 'Agent:Alice;Event:Bob' WHEN two THEN 'Viewer:Bob' END) AS fes,
round((CASE WHEN f THEN 1.0 ELSE 0 END + CASE WHEN m THEN 1.5 WHEN two THEN 1.0 ELSE 0 END)::DOUBLE / (CASE WHEN f THEN 1 ELSE 0 END + CASE WHEN m THEN 3 WHEN two THEN 2 ELSE 0 END), 6) AS score
FROM {_ROWS} WHERE m OR two OR f"""
)
def label_sentences(spark: SparkSession, d: str) -> DataFrame:
    out = labelling.label(_sentences(spark, d), _lexicon(spark), score="weighted")
    fes = F.array_join(F.transform("fes", lambda x: F.concat(x["fe"], F.lit(":"), x["chunk"])), ";")
    return out.select("id", "frame", fes.alias("fes"), F.round("score", 6).alias("score"))


def _serialised(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    labelled = spread(written(labelling.label(_sentences(spark, d), _lexicon(spark)), "labelled"))
    people = [("Alice", "Q10"), ("ALICE", "Q11"), *[(f"Name {n}", f"Q8{n}") for n in range(25)]]
    names = spark.createDataFrame(people, "label string, id string")
    pages = spark.createDataFrame([("Bob", "Q77")], "title string, id string")
    urls = serialise.url_subjects(spark.createDataFrame([(f"http://h/{n}", f"Q9{n}") for n in range(20)] + [("http://h/3", "Q1")], "url string, subject string"))
    return serialise.serialise(labelled, _lexicon(spark), names, pages, urls)


_SUBJECT = "CASE WHEN o_custkey % 40 < 20 AND o_custkey % 40 <> 3 THEN 'Q9' || o_custkey % 40 WHEN o_custkey % 50 < 25 THEN 'Q8' || o_custkey % 50 END"
_LINE = "chr(9) || 'S854' || chr(9) || '\"http://h/' || o_custkey % 40 || '\"'"
_DAY = "printf('%+012d-00-00T00:00:00Z/9', y)"


@query(
    f"""SELECT o_orderkey AS id, 'Q10' || chr(9) || 'P2' || chr(9) || 'Q77' || CASE WHEN f THEN chr(9) || 'P585' || chr(9) || {_DAY} ELSE '' END || {_LINE} AS statement FROM {_ROWS} WHERE m
UNION ALL SELECT o_orderkey, 'Q10' || chr(9) || 'P585' || chr(9) || {_DAY} || {_LINE} FROM {_ROWS} WHERE m AND f
UNION ALL SELECT o_orderkey, {_SUBJECT} || chr(9) || 'P571' || chr(9) || {_DAY} || {_LINE} FROM {_ROWS} WHERE NOT m AND NOT two AND f AND {_SUBJECT} IS NOT NULL"""
)
def serialise_statements(spark: SparkSession, d: str) -> DataFrame:
    return _serialised(spark, d)[0]


@query(
    f"""SELECT o_orderkey AS id, 'Bob' AS chunk FROM {_ROWS} WHERE NOT m AND two
UNION ALL SELECT o_orderkey, 'Name ' || o_custkey % 50 FROM {_ROWS} WHERE NOT m AND NOT two AND f AND {_SUBJECT} IS NULL"""
)
def serialise_unresolved(spark: SparkSession, d: str) -> DataFrame:
    return _serialised(spark, d)[1].select("id", "chunk")
