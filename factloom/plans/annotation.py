"""Queries of the annotation round trip, and positional ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import annotation, ordering
from factloom.plans.base import query
from factloom.session import table

LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


@query(
    """WITH v AS (SELECT user_id, json_extract_string(props, '$.k')::INT % 5 AS unit, event_type, count(*) AS votes FROM events GROUP BY ALL)
SELECT user_id, unit, event_type, votes FROM v QUALIFY row_number() OVER (PARTITION BY user_id, unit ORDER BY votes DESC, event_type) = 1"""
)
def majority_vote(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("unit", F.get_json_object("props", "$.k").cast("int") % 5)
    return annotation.majority(rows, ["user_id", "unit"], "event_type")


@query(
    """PIVOT (SELECT l_orderkey, l_returnflag || '-' || l_linenumber AS v, 'chunk_' || lpad(CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS VARCHAR), 2, '0') AS c FROM lineitem)
ON c USING max(v) GROUP BY l_orderkey"""
)
def unit_pivot(spark: SparkSession, d: str) -> DataFrame:
    """As many columns as the widest unit has."""
    rows = table(spark, d, "lineitem").select("l_orderkey", *LINE, F.concat_ws("-", "l_returnflag", F.col("l_linenumber").cast("string")).alias("chunk"))
    return annotation.units(rows, ["l_orderkey"], LINE, "chunk", None, "chunk")


@query(
    """SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS INTEGER) AS position, l_returnflag AS value FROM lineitem"""
)
def unit_unpivot(spark: SparkSession, d: str) -> DataFrame:
    """Every position of a unit, by way of the wide sheet."""
    wide = annotation.units(table(spark, d, "lineitem"), ["l_orderkey"], LINE, "l_returnflag", None, "fe")
    return annotation.unpivot(wide, ["l_orderkey"], "fe", len(wide.columns) - 1)


@query("SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) > 1")
def unit_check(spark: SparkSession, d: str) -> DataFrame:
    return annotation.constant(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag").select("l_orderkey")


@query("SELECT round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM labels")
def gold_accuracy(spark: SparkSession, d: str) -> DataFrame:
    answers = annotation.gold(F.when(F.col("quality") == 1, F.lit("good\nfine")).otherwise(F.lit("bad\nnone")))
    out = annotation.gold_accuracy(table(spark, d, "labels"), F.lit("good"), answers)
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query(
    """SELECT conv_id, turn, role, lag(role, 2) OVER w AS role_m2, lag(role) OVER w AS role_m1, lead(role) OVER w AS role_p1, lead(role, 2) OVER w AS role_p2
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"""
)
def context_window(spark: SparkSession, d: str) -> DataFrame:
    return ordering.context(table(spark, d, "conversations").select("conv_id", "turn", "role"), ["conv_id"], ["turn"], "role", 2)


@query(
    """WITH s AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS segment FROM conversations)
SELECT conv_id, CAST(segment AS BIGINT) AS segment, count(*) AS n_rows, md5(string_agg(text, '' ORDER BY turn)) AS body FROM s WHERE segment > 0 GROUP BY ALL"""
)
def segment_by_header(spark: SparkSession, d: str) -> DataFrame:
    rows = ordering.segments(table(spark, d, "conversations"), ["conv_id"], ["turn"], F.col("role") == "user").where("segment > 0")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "")
    return rows.groupBy("conv_id", "segment").agg(F.count("*").alias("n_rows"), F.md5(body).alias("body"))


@query(
    """WITH f AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM f)
SELECT user_id, CAST(run AS BIGINT) AS run, min(event_type) AS event_type, count(*) AS n, min(event_id) AS first_event FROM g GROUP BY user_id, run"""
)
def adjacent_group_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = ordering.adjacent_groups(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type")
    return rows.groupBy("user_id", "run").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query(
    r"""WITH p AS (SELECT doc_id, string_split(replace(replace(text, ', ', chr(1) || 'comma' || chr(2)), '. ', chr(1) || 'stop' || chr(2)), chr(1)) AS parts FROM documents),
u AS (SELECT doc_id, generate_subscripts(parts, 1) - 1 AS part_no, unnest(parts) AS part FROM p)
SELECT doc_id, CAST(part_no AS INTEGER) AS part_no, CASE WHEN part_no > 0 THEN string_split(part, chr(2))[1] END AS delimiter, length(CASE WHEN part_no > 0 THEN string_split(part, chr(2))[2] ELSE part END) AS n FROM u"""
)
def delimiter_split(spark: SparkSession, d: str) -> DataFrame:
    """Text cut at delimiters: each part with the delimiter before it; the first part has none, and the last one is kept."""
    marked = F.replace(F.replace("text", F.lit(", "), F.lit("\1comma\2")), F.lit(". "), F.lit("\1stop\2"))
    parts = table(spark, d, "documents").select("doc_id", F.posexplode(F.split(marked, "\1")).alias("part_no", "part"))
    two = F.split("part", "\2")
    return parts.select("doc_id", "part_no", F.when(F.col("part_no") > 0, two[0]).alias("delimiter"), F.length(F.when(F.col("part_no") > 0, two[1]).otherwise(F.col("part"))).cast("long").alias("n"))
