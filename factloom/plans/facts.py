"""Queries about dates, names, frames and statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import dates, filters
from factloom.functions import text as T
from factloom.operators import extraction, frames, kb, learning, linking, statements
from factloom.plans.base import query
from factloom.session import spread, table, texts

_FMT = "printf('%+012d-%02d-%02dT00:00:00Z/%d', year(o_orderdate), month(o_orderdate), day(o_orderdate), 11)"


@query(f"SELECT o_orderkey, {_FMT} AS formatted FROM orders")
def date_format(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select("o_orderkey", dates.format_date(F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate")).alias("formatted"))


@query("SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, CASE WHEN o_orderkey % 2 = 0 THEN day(o_orderdate)::INT ELSE 0 END AS day FROM orders")
def date_parse(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    day = F.when(F.col("o_orderkey") % 2 == 0, F.day("o_orderdate"))
    back = dates.parse_date(dates.format_date(F.year("o_orderdate"), F.month("o_orderdate"), day))
    return o.select("o_orderkey", back.alias("p")).select("o_orderkey", "p.year", "p.month", F.coalesce("p.day", F.lit(0)).alias("day"))


@query(
    """SELECT o_orderkey, category, CAST(y AS INTEGER) AS year, CAST(coalesce(m, 0) AS INTEGER) AS month, CAST(coalesce(y2, 0) AS INTEGER) AS end_year FROM (
SELECT o_orderkey, 'Time' AS category, year(o_orderdate) AS y, month(o_orderdate) AS m, NULL AS y2 FROM orders UNION ALL
SELECT o_orderkey, 'Duration', year(o_orderdate), NULL, year(o_orderdate) + 3 FROM orders)"""
)
def date_normalize(spark: SparkSession, d: str) -> DataFrame:
    year, o = F.year("o_orderdate"), spread(table(spark, d, "orders"))
    phrase = F.concat(F.lit("Sent in "), F.date_format("o_orderdate", "MMMM yyyy"), F.lit(" and stored from "), year.cast("string"), F.lit(" to "), (year + 3).cast("string"), F.lit("."))
    each = o.select("o_orderkey", F.explode(dates.normalize(phrase)).alias("x"))
    return each.select("o_orderkey", "x.category", F.coalesce("x.time.year", "x.from.year").alias("year"), F.coalesce("x.time.month", F.lit(0)).alias("month"), F.coalesce("x.until.year", F.lit(0)).alias("end_year"))


_BD = "CASE o_orderkey % 4 WHEN 0 THEN y || '-' || (y + 61) WHEN 1 THEN 'b. ' || y WHEN 2 THEN 'd.ca.' || y ELSE 'c. ' || y || ' – ?' END"


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1, 3) THEN CAST(year(o_orderdate) AS VARCHAR) END AS birth,
CASE o_orderkey % 4 WHEN 0 THEN CAST(year(o_orderdate) + 61 AS VARCHAR) WHEN 2 THEN CAST(year(o_orderdate) AS VARCHAR) END AS death FROM orders"""
)
def birth_death_parse(spark: SparkSession, d: str) -> DataFrame:
    y = F.year("o_orderdate")
    s, k = y.cast("string"), F.col("o_orderkey") % 4
    text = F.when(k == 0, F.concat(s, F.lit("-"), (y + 61).cast("string"))).when(k == 1, F.concat(F.lit("b. "), s)).when(k == 2, F.concat(F.lit("d.ca."), s)).otherwise(F.concat(F.lit("c. "), s, F.lit(" – ?")))
    return table(spark, d, "orders").select("o_orderkey", T.birth_death(text).alias("x")).select("o_orderkey", "x.birth", "x.death")


@query("SELECT c_custkey, lower(c_mktsegment) || ' number' || c_custkey AS name FROM customer")
def fix_name(spark: SparkSession, d: str) -> DataFrame:
    key, segment = F.col("c_custkey").cast("string"), F.initcap("c_mktsegment")
    text = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Number"), key, F.lit(", Sir "), segment, F.lit(" Middle (b. 1900)"))).otherwise(F.concat(F.lit("Prof. Dr "), segment, F.lit(" van Number"), key))
    return table(spark, d, "customer").select("c_custkey", T.fix_name(text).alias("name"))


_LEX = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in extraction.LEXICON) + ") AS lex(lemma, token, tpos)"
FRAMES = (("be", "Being", "V"), ("have", "Possession", "V"), ("end", "Process_end", "VX"), ("stand", "Posture", "V"))
_FRAMES = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in FRAMES) + ") AS fr(lemma, frame, fpos)"


@query(
    rf"""WITH t AS (SELECT doc_id, generate_subscripts(w, 1) - 1 AS pos_no, unnest(w) AS token FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM documents))
SELECT doc_id, CAST(pos_no AS INTEGER) AS pos_no, lemma, frame FROM t JOIN {_LEX} USING (token) JOIN {_FRAMES} USING (lemma) WHERE starts_with(tpos, fpos)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pos_no, frame) = 1"""
)
def frame_first_match(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select("doc_id", F.posexplode(T.tokens("text", lower=True)).alias("pos_no", "token"))
    tags = words.join(F.broadcast(extraction.lexicon(spark)), "token")
    known = spark.createDataFrame(list(FRAMES), "lemma string, frame string, pos string")
    return frames.first_frame(tags, known, ["doc_id"], "pos_no").select("doc_id", "pos_no", "lemma", "frame")


ELEMENTS = (("Agent", True, "STANDARD"), ("Place", False, "STANDARD"), ("Theme", True, "PROMO"), ("Goal", False, "Brand#1"), ("Source", False, "Brand#7"))
_ELEMENTS = "(VALUES " + ", ".join(f"('{a}', {str(b).lower()}, '{c}')" for a, b, c in ELEMENTS) + ") AS el(fe, core, class)"


@query(
    f"""WITH e AS (SELECT p_partkey, p_size, CASE WHEN p_size % 2 = 0 THEN [p_brand, p_type] ELSE [p_type] END AS types FROM part),
x AS (SELECT p_partkey, p_size, len(types) AS n, generate_subscripts(types, 1) AS i, unnest(types) AS class FROM e),
m AS (SELECT * FROM x JOIN {_ELEMENTS} USING (class) QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY i, core DESC, fe) = 1)
SELECT p_size, p_partkey, fe, CAST(row_number() OVER (PARTITION BY p_size ORDER BY n DESC, p_partkey) AS INTEGER) AS entity_rank FROM m"""
)
def fe_assignment(spark: SparkSession, d: str) -> DataFrame:
    types = F.when(F.col("p_size") % 2 == 0, F.array("p_brand", "p_type")).otherwise(F.array("p_type"))
    known = spark.createDataFrame(list(ELEMENTS), "fe string, core boolean, class string")
    return frames.assign_elements(table(spark, d, "part").select("p_size", "p_partkey", types.alias("types")), known, ["p_size"], "p_partkey").select("p_size", "p_partkey", "fe", "entity_rank")


@query(
    """WITH x AS (SELECT l_orderkey, l_discount + 0.01 AS s, CASE WHEN l_linenumber <= 2 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM lineitem)
SELECT l_orderkey, round(avg(s), 6) AS arithmetic, round(sum(w * s) / sum(w), 6) AS weighted, round(sum(w) / sum(w / s), 6) AS harmonic FROM x GROUP BY l_orderkey"""
)
def weighted_score(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("s", F.col("l_discount") + 0.01)
    out = frames.sentence_scores(rows, ["l_orderkey"], "s", F.col("l_linenumber") <= 2)
    return out.select("l_orderkey", *[F.round(c, 6).alias(c) for c in ("arithmetic", "weighted", "harmonic")])


@query(
    """SELECT user_id, event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY CASE WHEN value > 50 THEN 1 ELSE 0 END DESC, event_id DESC) = 1"""
)
def custom_fe_priority(spark: SparkSession, d: str) -> DataFrame:
    place = F.when(F.col("value") > 50, 1).otherwise(0)
    return frames.prioritized(table(spark, d, "events"), ["user_id"], "event_type", place, "event_id").select("user_id", "event_type", "event_id")


@query(
    r"""SELECT c_custkey, statement FROM (
SELECT c_custkey, 'Q' || c_custkey || chr(9) || 'P27' || chr(9) || 'Q' || c_nationkey || chr(9) || 'S854' || chr(9) || '"http://example.org/' || c_custkey || '"' AS statement FROM customer WHERE c_acctbal >= 0)"""
)
def statement_lines(spark: SparkSession, d: str) -> DataFrame:
    q = lambda c: F.concat(F.lit("Q"), F.col(c).cast("string"))
    url = F.concat(F.lit("http://example.org/"), F.col("c_custkey").cast("string"))
    value = F.when(F.col("c_acctbal") >= 0, q("c_nationkey"))
    out = table(spark, d, "customer").select("c_custkey", statements.statement(q("c_custkey"), F.lit("P27"), value, *statements.reference(url)).alias("statement"))
    return out.where("statement is not null")


FIELDS = (("born", "P569"), ("sex", "P21"), ("name", "P1559"), ("child", "P40"))


def _records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    fields = F.create_map(
        F.lit("born"), F.concat(F.lit("c. "), F.date_format("o_orderdate", "yyyy-MM-dd")), F.lit("sex"), F.when(F.col("o_orderstatus") == "F", "Female").otherwise(F.lit("?")),
        F.lit("child"), F.col("o_orderpriority"), F.lit("hobby"), F.lit("none"),
    )
    orders = spread(table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"), 256 << 20)
    rows = orders.select(F.concat(F.lit("Q"), F.col("o_orderkey").cast("string")).alias("subject"), fields.alias("fields"), F.lit("http://example.org/o").alias("url"))
    return statements.from_fields(rows, "subject", "fields", spark.createDataFrame(list(FIELDS), "field string, property string"), "url")


@query(
    f"""SELECT 'Q' || o_orderkey AS subject, 'P569' AS property, 'Q' || o_orderkey || chr(9) || 'P569' || chr(9) || {_FMT} || chr(9) || 'S854' || chr(9) || '"http://example.org/o"' AS statement FROM orders
UNION ALL SELECT 'Q' || o_orderkey, 'P21', 'Q' || o_orderkey || chr(9) || 'P21' || chr(9) || 'Q6581072' || chr(9) || 'S854' || chr(9) || '"http://example.org/o"' FROM orders WHERE o_orderstatus = 'F'"""
)
def semi_structured_statements(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d)[0]


@query("SELECT 'Q' || o_orderkey AS subject, 'P40' AS property, o_orderpriority AS chunk FROM orders UNION ALL SELECT 'Q' || o_orderkey, 'P21', '?' FROM orders WHERE o_orderstatus <> 'F'")
def semi_structured_unresolved(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d)[1].drop("url")


@query(
    """WITH x AS (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'P585' WHEN 'O' THEN 'P580' ELSE 'P276' END AS property, strftime(o_orderdate, '%Y-%m') AS v FROM orders)
SELECT o_custkey, property, array_to_string(list_sort(list(DISTINCT v)), '|') AS values FROM x GROUP BY ALL"""
)
def qualifier_map(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "F", "Time").when(F.col("o_orderstatus") == "O", "Start").otherwise("Place")
    return statements.qualifiers(table(spark, d, "orders"), "o_custkey", kind, F.date_format("o_orderdate", "yyyy-MM"))


GAZETTEER = (("of the", "E1"), ("is", "E2"), ("was", "E2"), ("und", "E3"), ("de la", "E4"), ("the", "E5"), ("the", "E6"), ("en", "E7"), ("que la", "E8"))
_GAZ = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in GAZETTEER) + ") AS g(chunk, entity)"


@query(
    rf"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM documents),
t AS (SELECT doc_id, generate_subscripts(w, 1) - 1 AS position, unnest(w) AS token FROM w),
n AS (SELECT doc_id, position, token AS chunk FROM t UNION ALL SELECT a.doc_id, a.position, a.token || ' ' || b.token FROM t a JOIN t b ON a.doc_id = b.doc_id AND b.position = a.position + 1)
SELECT doc_id, CAST(position AS INTEGER) AS position, chunk, entity, 1.0::DOUBLE / (SELECT count(*) FROM {_GAZ} WHERE g.chunk = n.chunk) AS confidence FROM n JOIN {_GAZ} USING (chunk)"""
)
def entity_linking(spark: SparkSession, d: str) -> DataFrame:
    known = spark.createDataFrame(list(GAZETTEER), "alias string, entity string")
    return linking.link(texts(spark, d), known, most=2)


@query(
    """WITH c AS (SELECT o_orderkey AS person, o_custkey % 50 AS entity, (o_orderstatus = 'F')::INT AS a, (o_orderpriority = '1-URGENT')::INT AS b FROM orders)
SELECT person, 'E' || entity AS entity, a * 1.0::DOUBLE + b * 0.5::DOUBLE AS score FROM c WHERE a * 1.0 + b * 0.5 >= 1"""
)
def person_disambiguation(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("person"), F.concat(F.lit("Name"), (F.col("o_custkey") % 50).cast("string")).alias("name"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    claims = o.select("person", F.explode(F.create_map(F.lit("P1"), F.col("status"), F.lit("P2"), F.col("priority"))).alias("property", "value"))
    kb = spark.range(50).select(F.concat(F.lit("E"), F.col("id").cast("string")).alias("entity"), F.concat(F.lit("name"), F.col("id").cast("string")).alias("label"), F.explode(F.create_map(F.lit("P1"), F.lit("F"), F.lit("P2"), F.lit("1-URGENT"))).alias("property", "value"))
    return statements.disambiguate(o.select("person", "name"), claims, kb, {"P1": 1.0, "P2": 0.5})


@query(
    """SELECT 'Q' || s_suppkey AS id, 'Q' || s_suppkey || chr(9) || 'P131' || chr(9) || 'it:"Place' || s_nationkey || '"' || chr(9) || 'P31' || chr(9) ||
CASE s_suppkey % 3 WHEN 0 THEN 'Q747074' WHEN 1 THEN 'Q15089' ELSE 'Q486972' END AS statement FROM supplier"""
)
def monument_statements(spark: SparkSession, d: str) -> DataFrame:
    kind = F.element_at(F.array(F.lit("com. "), F.lit("Prov. "), F.lit("")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    rows = table(spark, d, "supplier").select(F.concat(F.lit("Q"), F.col("s_suppkey").cast("string")).alias("id"), F.concat(kind, F.lit("Place"), F.col("s_nationkey").cast("string")).alias("place"))
    return statements.monuments(rows)


@query("SELECT c_custkey, 'en:\"O''Neil-' || upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || '\"' AS name FROM customer")
def title_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", T.literal(T.title_case(F.concat(F.lit("o'NEIL-"), F.col("c_mktsegment"))), "en").alias("name"))


@query("SELECT p_partkey, CAST(p_size AS VARCHAR) || '-' || right('00' || (p_size % 100), 2) AS span, CASE WHEN p_size >= 1 THEN '15' || right('00' || (p_size % 100), 2) END AS year FROM part")
def end_year_completion(spark: SparkSession, d: str) -> DataFrame:
    two = F.lpad((F.col("p_size") % 100).cast("string"), 2, "0")
    return table(spark, d, "part").select("p_partkey", F.concat(F.col("p_size").cast("string"), F.lit("-"), two).alias("span"), T.complete_year(F.lit("1515"), two).alias("year"))


@query(
    """WITH k AS (SELECT DISTINCT lower(n_name) AS key FROM nation),
h AS (SELECT key, 0 AS s, 'C' || c_custkey AS id FROM k JOIN customer JOIN nation ON c_nationkey = n_nationkey ON lower(n_name) = key UNION ALL SELECT key, 1, 'S' || s_suppkey FROM k JOIN supplier JOIN nation ON s_nationkey = n_nationkey ON lower(n_name) = key),
r AS (SELECT *, row_number() OVER (PARTITION BY key, s ORDER BY id) AS n FROM h QUALIFY n <= 15)
SELECT key AS term, id, CAST(row_number() OVER (PARTITION BY key ORDER BY s, n) AS INTEGER) AS rank FROM r"""
)
def entity_search(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").withColumnRenamed("n_nationkey", "nk")
    labels = table(spark, d, "customer").withColumnRenamed("c_nationkey", "nk").join(nation, "nk").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"), F.col("n_name").alias("label"))
    pages = table(spark, d, "supplier").withColumnRenamed("s_nationkey", "nk").join(nation, "nk").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"), F.col("n_name").alias("title"))
    return kb.search(nation.select(F.lower("n_name").alias("term")).distinct(), labels, pages)


@query("SELECT page_id, replace(string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1], '_', ' ') AS title FROM pages")
def url_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", kb.title_of(F.col("url")).alias("title"))


@query("SELECT o_orderkey, CASE WHEN year(o_orderdate) <= 1997 THEN year(o_orderdate) ELSE 0 END AS year FROM orders")
def future_year_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.coalesce(filters.past_year(F.year("o_orderdate"), F.lit(1997)), F.lit(0)).cast("long").alias("year"))


@query(
    """SELECT user_id, event_id, array_to_string(list_filter(['type-1=' || lag(event_type) OVER w, 'type+0=' || event_type, 'type+1=' || lead(event_type) OVER w], lambda x: x IS NOT NULL), ' ') AS features
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)"""
)
def window_features(spark: SparkSession, d: str) -> DataFrame:
    rows = learning.window_features(table(spark, d, "events").withColumnRenamed("event_type", "type"), ["user_id"], "event_id", 1, ("type",))
    return rows.select("user_id", "event_id", F.array_join("features", " ").alias("features"))


_WANT = """(SELECT DISTINCT CASE c_custkey % 3 WHEN 0 THEN 'P19' WHEN 1 THEN 'P27' ELSE 'P106' END AS property,
CASE c_custkey % 3 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) || 'ish' ELSE 'BUILDING/' || c_mktsegment END AS value, n_nationkey, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@query(
    f"""SELECT DISTINCT property, value, CASE WHEN property = 'P106' THEN 'O' || c_mktsegment ELSE 'Q' || n_nationkey END AS id FROM {_WANT} WHERE property <> 'P106' OR c_mktsegment <> 'BUILDING'"""
)
def searched_values(spark: SparkSession, d: str) -> DataFrame:
    """Places, nationalities and professions found by name; BUILDING names two things, so it is no profession."""
    nation, customer = table(spark, d, "nation"), table(spark, d, "customer")
    want = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    kind = F.col("c_custkey") % 3
    rows = want.select(
        F.when(kind == 0, "P19").when(kind == 1, "P27").otherwise("P106").alias("property"),
        F.when(kind == 0, F.col("n_name")).when(kind == 1, F.concat(F.lower("n_name"), F.lit("ish"))).otherwise(F.concat(F.lit("BUILDING/"), F.col("c_mktsegment"))).alias("value"),
    )
    places = nation.select(F.col("n_name").alias("label"), F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")).alias("id"), F.lit("country").alias("type"))
    jobs = customer.select(F.col("c_mktsegment").alias("label"), F.concat(F.lit("O"), F.col("c_mktsegment")).alias("id"), F.lit("profession").alias("type")).distinct()
    twice = spark.createDataFrame([("building", "O2", "profession")], "label string, id string, type string")
    nationalities = nation.select(F.concat(F.lower("n_name"), F.lit("ish")).alias("adjective"), F.col("n_name").alias("country"))
    return statements.searched(rows, places.unionByName(jobs).unionByName(twice), nationalities)
