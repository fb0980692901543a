"""Queries of the join family."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import text as T
from factloom.operators import joins
from factloom.plans.base import query
from factloom.session import table, texts

#: Adjectives of some nations; a small fixed dimension.
NATIONALITY = tuple((f"adjective{i}", f" Nation_{i} ".strip()) for i in range(0, 25, 2))
#: Things, the words for them, and other words.
THINGS = (("circle", "ring hoop"), ("Widget", "gadget"), ("bolt", "screw nail"), ("plate", ""))
#: Sources and the property that identifies a person in them.
SOURCE_PROPERTY = (("src0", "P1415"), ("src1", "P650"), ("src2", "P245"), ("src3", "P1816"), ("src4", "P2163"))


@query(
    """SELECT l_orderkey, l_linenumber, o_orderstatus, c_name, n.n_name AS customer_nation, r.r_name AS region, p_name, s_name, sn.n_name AS supplier_nation
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation n ON c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey"""
)
def left_outer_chain(spark: SparkSession, d: str) -> DataFrame:
    t = lambda name: table(spark, d, name)
    nation = t("nation").join(t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey", "left")
    chain = joins.left_chain(
        t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        (t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_custkey"), "l_orderkey"),
        (t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"), "o_custkey"),
        (nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_nation"), F.col("r_name").alias("region")), "c_nationkey"),
        (t("part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey"),
        (t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey"), "l_suppkey"),
        (t("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation")), "s_nationkey"),
    )
    return chain.select("l_orderkey", "l_linenumber", "o_orderstatus", "c_name", "customer_nation", "region", "p_name", "s_name", "supplier_nation")


_KEY = "CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d')"


@query(
    f"""WITH e AS (SELECT *, {_KEY} AS url FROM events), k AS (SELECT url, min(event_type) AS subject FROM e GROUP BY url HAVING min(event_type) = max(event_type))
SELECT event_id, url, coalesce(subject, '') AS subject FROM e LEFT JOIN k USING (url)"""
)
def url_to_subject_unambiguous(spark: SparkSession, d: str) -> DataFrame:
    url = F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyy-MM-dd"))
    events = table(spark, d, "events").withColumn("url", url)
    known = joins.unambiguous(events, "url", "event_type").withColumnRenamed("event_type", "subject")
    return events.join(known, "url", "left").select("event_id", "url", F.coalesce("subject", F.lit("")).alias("subject"))


def _family(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    links = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("member"))
    known = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("member"), "c_name")
    return joins.resolve(links, known, "member", "c_name")


@query("SELECT o_orderkey, o_custkey AS member, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0")
def family_links_resolved(spark: SparkSession, d: str) -> DataFrame:
    return _family(spark, d)[0].select("o_orderkey", "member", "c_name")


@query("SELECT o_orderkey, o_custkey AS member FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE o_custkey = c_custkey AND c_acctbal > 0)")
def family_links_unresolved(spark: SparkSession, d: str) -> DataFrame:
    return _family(spark, d)[1].select("o_orderkey", "member")


_THINGS = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in THINGS) + ") AS x(thing, aliases)"


@query(f"SELECT p_partkey, thing FROM part, {_THINGS} WHERE lower(string_split(p_name, ' ')[2]) = lower(thing) OR list_contains(string_split(lower(aliases), ' '), lower(string_split(p_name, ' ')[2]))")
def label_alias_match(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "part").select("p_partkey", F.element_at(F.split("p_name", " "), 2).alias("label"))
    names = spark.createDataFrame(list(THINGS), "thing string, aliases string").withColumn("aliases", F.split("aliases", " "))
    return joins.label_alias_matches(labels, F.broadcast(names), "label", "thing", "aliases").select("p_partkey", "thing")


_NAT = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in NATIONALITY) + ") AS x(adjective, country)"


@query(f"SELECT c_custkey, coalesce(adjective, '') AS nationality FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN {_NAT} ON lower(trim(n_name)) = lower(country)")
def nationality_lookup(spark: SparkSession, d: str) -> DataFrame:
    known = spark.createDataFrame(list(NATIONALITY), "adjective string, country string").withColumn("place", F.lower("country"))
    nation = table(spark, d, "nation").withColumn("place", F.lower(F.trim("n_name"))).join(F.broadcast(known), "place", "left")
    out = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return out.select("c_custkey", F.coalesce("adjective", F.lit("")).alias("nationality"))


_SRC = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in SOURCE_PROPERTY) + ") AS x(source, property)"


@query(f"SELECT doc_id, source, property FROM documents JOIN {_SRC} USING (source)")
def source_identifier(spark: SparkSession, d: str) -> DataFrame:
    known = spark.createDataFrame(list(SOURCE_PROPERTY), "source string, property string")
    return table(spark, d, "documents").select("doc_id", "source").join(F.broadcast(known), "source")


@query(
    """WITH o AS (SELECT o_custkey, o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS dd FROM orders)
SELECT a.o_orderkey AS a, b.o_orderkey AS b, CAST((a.y = b.y)::INT + (a.m = b.m)::INT + (a.dd = b.dd)::INT AS INTEGER) AS matches FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey
WHERE (a.y = b.y)::INT + (a.m = b.m)::INT + (a.dd = b.dd)::INT > 0"""
)
def date_overlap(spark: SparkSession, d: str) -> DataFrame:
    dates = table(spark, d, "orders").select(F.col("o_custkey").alias("who"), F.col("o_orderkey").alias("a"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), F.day("o_orderdate").alias("day"))
    both = joins.overlapping_dates(dates, dates.withColumnRenamed("a", "b"), "who", carry=("b",))
    return both.where("a < b and matches > 0").select("a", "b", "matches")


@query(
    """WITH s AS (SELECT l_suppkey, list(DISTINCT l_returnflag) AS a, list(DISTINCT l_linestatus) || list(DISTINCT substr(l_returnflag, 1, 1)) AS b FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, CAST(len(list_intersect(a, b)) * 0.5 AS DOUBLE) AS score FROM s"""
)
def value_set_intersection(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.collect_set("l_returnflag").alias("a"), F.concat(F.collect_set("l_linestatus"), F.collect_set(F.substring("l_returnflag", 1, 1))).alias("b"))
    return s.select("l_suppkey", joins.weighted_overlap(F.col("a"), F.col("b"), 0.5).alias("score"))


@query(
    """WITH w AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents), h AS (SELECT doc_id, w, CAST((len(w) + 1) // 2 AS BIGINT) AS n FROM w),
z AS (SELECT doc_id, unnest(w[1:len(w) - n]) AS key, unnest(w[n + 1:]) AS value, generate_subscripts(w[n + 1:], 1) AS i FROM h)
SELECT doc_id, key, value FROM z QUALIFY row_number() OVER (PARTITION BY doc_id, key ORDER BY i DESC) = 1"""
)
def key_value_zip(spark: SparkSession, d: str) -> DataFrame:
    """The first half of each text's words as keys of the second half, however long the text."""
    words, half = F.split("text", " "), F.ceil(F.size("w") / 2).cast("int")
    both = texts(spark, d).select("doc_id", words.alias("w")).select("doc_id", F.slice("w", 1, half).alias("k"), F.slice("w", half + 1, F.size("w")).alias("v"))
    return joins.zipped(both, "doc_id", "k", "v")


@query("SELECT n_name, r_name FROM nation, region")
def template_cross(spark: SparkSession, d: str) -> DataFrame:
    """Every field block in every chunk block: a cross product of two fixed small dimensions, as a report template needs it."""
    return table(spark, d, "nation").select("n_name").crossJoin(F.broadcast(table(spark, d, "region").select("r_name")))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def instance_of_filter(spark: SparkSession, d: str) -> DataFrame:
    claims = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey").join(claims, "c_custkey", "left_semi")
