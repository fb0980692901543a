"""Queries over the corpus: tokens, rankings, statistics, sentences, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import text as T
from factloom.operators import extraction, ordering, ranking, sampling, stats, tagging
from factloom.plans.base import query
from factloom.session import table, texts

STOPWORDS = ("the", "of", "and", "to", "in", "is", "was", "a", "la", "de", "le", "der", "die", "und", "que", "et")
_TOK = r"list_filter(regexp_split_to_array(text, '[^\p{L}\p{N}]+'), lambda x: x <> '')"
_LOW = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
_SENT = r"list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '')"
_SENTS = f"SELECT doc_id, generate_subscripts(s, 1) - 1 AS sent_no, unnest(s) AS sentence FROM (SELECT doc_id, {_SENT} AS s FROM documents)"
_LEX = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in extraction.LEXICON) + ") AS lex(lemma, token, pos)"
_STOP = "(" + ", ".join(f"'{w}'" for w in STOPWORDS) + ")"


@query(f"SELECT doc_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS token FROM (SELECT doc_id, {_TOK} AS t FROM documents)")
def tokenize_corpus(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).select("doc_id", F.posexplode(T.tokens("text")).alias("pos", "token"))


@query(f"SELECT token, count(*) AS n FROM (SELECT unnest({_LOW}) AS token FROM documents) WHERE token NOT IN {_STOP} GROUP BY token")
def stopword_filter(spark: SparkSession, d: str) -> DataFrame:
    words = texts(spark, d).select(F.explode(T.tokens("text", lower=True)).alias("token"))
    stop = spark.createDataFrame([(w,) for w in STOPWORDS], "token string")
    return words.join(F.broadcast(stop), "token", "left_anti").groupBy("token").agg(F.count("*").alias("n"))


_TFIDF = f"""
tf AS (SELECT doc_id AS doc, term, count(*) AS tf FROM (SELECT doc_id, unnest({_LOW}) AS term FROM documents) WHERE length(term) >= 2 GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw AS (SELECT doc, term, df, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS raw FROM tf JOIN df USING (term)),
norm AS (SELECT doc, sqrt(sum(raw * raw)) AS norm FROM raw GROUP BY doc),
score AS (SELECT term, df, raw / norm AS score FROM raw JOIN norm USING (doc)),
by_term AS (SELECT term, df, avg(score) AS avg_score, sum(score) / (SELECT count(*) FROM documents) AS m, sum(score * score) / (SELECT count(*) FROM documents) AS q FROM score GROUP BY term, df),
ranked AS (SELECT term, df, avg_score, sqrt(greatest(0.0, q - m * m)) AS sd_score FROM by_term)"""


@query(f"WITH {_TFIDF} SELECT term, df, round(avg_score, 6) AS avg_score, round(sd_score, 6) AS sd_score FROM ranked WHERE df >= 5")
def term_tfidf(spark: SparkSession, d: str) -> DataFrame:
    out = ranking.tfidf_rank(texts(spark, d), 5)
    return out.select("term", "df", F.round("avg_score", 6).alias("avg_score"), F.round("sd_score", 6).alias("sd_score"))


@query(f"WITH {_TFIDF} SELECT term, round(avg_score, 6) AS avg_score FROM ranked WHERE df >= 5 ORDER BY round(avg_score, 6) DESC, term LIMIT 150")
def term_tfidf_rank(spark: SparkSession, d: str) -> DataFrame:
    out = ranking.tfidf_rank(texts(spark, d), 5).select("term", F.round("avg_score", 6).alias("avg_score"))
    return out.orderBy(F.desc("avg_score"), "term").limit(150)


_POP = f"pop AS (SELECT term, count(*) AS n FROM (SELECT unnest({_LOW}) AS term FROM documents) WHERE length(term) >= 2 GROUP BY term)"


@query(f"WITH {_POP} SELECT term, n, round(n / (SELECT max(n) FROM pop), 6) AS popularity FROM pop")
def term_popularity_rank(spark: SparkSession, d: str) -> DataFrame:
    return ranking.popularity(texts(spark, d)).select("term", "n", F.round("popularity", 6).alias("popularity"))


@query(
    f"""WITH {_TFIDF}, {_POP}, three AS (SELECT term, avg_score AS a, sd_score AS b, n / (SELECT max(n) FROM pop) AS c FROM ranked JOIN pop USING (term) WHERE df >= 2)
SELECT term, round(3 * a * b * c / (1 + a + b + c), 6) AS score FROM three"""
)
def harmonic_rank(spark: SparkSession, d: str) -> DataFrame:
    return ranking.harmonic(texts(spark, d), 2).select("term", F.round("score", 6).alias("score"))


@query(f"WITH {_POP} SELECT term, n FROM pop ORDER BY n DESC, term LIMIT 150")
def top_n_terms(spark: SparkSession, d: str) -> DataFrame:
    return ranking.popularity(texts(spark, d)).select("term", "n").orderBy(F.desc("n"), "term").limit(150)


@query(
    f"""WITH t AS (SELECT source, term, count(*) AS n FROM (SELECT source, unnest({_LOW}) AS term FROM documents) GROUP BY ALL)
SELECT source, term, n, CAST(row_number() OVER (PARTITION BY source ORDER BY n DESC, term) AS INTEGER) AS rank FROM t QUALIFY rank <= 15"""
)
def top15_per_source(spark: SparkSession, d: str) -> DataFrame:
    each = texts(spark, d).select("source", F.explode(T.tokens("text", lower=True)).alias("term"))
    return ranking.top_per_group(each.groupBy("source", "term").agg(F.count("*").alias("n")), ["source"], [F.desc("n"), "term"], 15)


@query(
    f"""WITH v AS (SELECT DISTINCT token, regexp_replace(token, '(ing|ed|es|s)$', '') AS lemma FROM (SELECT unnest({_LOW}) AS token FROM documents) WHERE regexp_matches(token, '(ing|ed)$'))
SELECT lemma, string_agg(token, ' ' ORDER BY token) AS tokens, count(*) AS n_tokens FROM v WHERE lemma <> '' GROUP BY lemma"""
)
def lemma_tokens(spark: SparkSession, d: str) -> DataFrame:
    return ranking.lemma_tokens(texts(spark, d))


_LEMMAS = r"lem AS (SELECT DISTINCT term, regexp_replace(term, '(ing|ed|es|s)$', '') AS lemma FROM pop WHERE regexp_matches(term, '(ing|ed)$'))"


@query(
    f"""WITH {_TFIDF}, {_POP}, {_LEMMAS} SELECT lemma, round(sum(avg_score * df) / sum(df), 6) AS avg_score, round(avg(sd_score), 6) AS sd_score FROM lem JOIN ranked USING (term) WHERE lemma <> '' GROUP BY lemma"""
)
def lemma_rank(spark: SparkSession, d: str) -> DataFrame:
    """Scores of verbs' lemmas, pooled over their tokens."""
    docs = texts(spark, d)
    out = ranking.lemma_scores(docs, ranking.lemma_tokens(docs).select("lemma", F.explode(F.split("tokens", " ")).alias("token")))
    return out.select("lemma", F.round("avg_score", 6).alias("avg_score"), F.round("sd_score", 6).alias("sd_score"))


@query(f"WITH {_POP}, {_LEMMAS}, b AS (SELECT lemma, CAST(sum(n) AS BIGINT) AS n FROM lem JOIN pop USING (term) WHERE lemma <> '' GROUP BY lemma) SELECT lemma, n, round(n / (SELECT max(n) FROM b), 6) AS popularity FROM b")
def lemma_popularity_rank(spark: SparkSession, d: str) -> DataFrame:
    docs = texts(spark, d)
    out = ranking.lemma_popularity(docs, ranking.lemma_tokens(docs).select("lemma", F.explode(F.split("tokens", " ")).alias("token")))
    return out.select("lemma", "n", F.round("popularity", 6).alias("popularity"))


_HOST = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"


@query(f"SELECT coalesce(nullif({_HOST}, ''), '_skipped_') AS source, count(*) AS n FROM pages GROUP BY 1")
def source_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.source_counts(table(spark, d, "pages"), T.host("url"))


@query(
    f"""WITH c AS (SELECT coalesce(nullif({_HOST}, ''), '_skipped_') AS source, count(*) AS n FROM pages GROUP BY 1), s AS (SELECT *, n / sum(n) OVER () AS share FROM c)
SELECT CASE WHEN share >= 0.01 THEN source ELSE 'Rest' END AS source, CAST(sum(n) AS BIGINT) AS n, round(sum(n) / (SELECT sum(n) FROM c), 6) AS share FROM s GROUP BY 1"""
)
def source_share(spark: SparkSession, d: str) -> DataFrame:
    return stats.source_share(table(spark, d, "pages"), T.host("url")).withColumn("share", F.round("share", 6))


@query("SELECT CAST(floor(n_chars * 20 / (SELECT max(n_chars) FROM documents)) AS BIGINT) AS bucket, count(*) AS n FROM documents GROUP BY 1")
def bio_length_histogram(spark: SparkSession, d: str) -> DataFrame:
    return stats.length_histogram(table(spark, d, "documents"), "n_chars", 20)


@query(
    """SELECT count(*) AS total, count(*) FILTER (length(text) >= 50) AS with_text, count(*) FILTER (length(text) > 50) AS longer,
round(100.0 * count(*) FILTER (length(text) >= 50) / count(*), 6) AS percentage, CAST(sum(CASE WHEN length(text) > 50 THEN length(text) ELSE 0 END) AS BIGINT) AS characters FROM documents"""
)
def bio_counters(spark: SparkSession, d: str) -> DataFrame:
    return stats.counters(table(spark, d, "documents"), "text", 50).withColumn("percentage", F.round("percentage", 6))


@query("SELECT doc_id, sha1(text) AS id, length(text) AS n FROM documents WHERE length(text) > 50")
def preprocess_sha1(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(F.length("text") > 50).select("doc_id", F.sha1("text").alias("id"), F.length("text").cast("long").alias("n"))


@query(r"SELECT doc_id, length(c) AS n, md5(c) AS md5 FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '\s+(\s)', '\1', 'g'), '^\s+|\s+$', '', 'g') AS c FROM documents)")
def clean_whitespace(spark: SparkSession, d: str) -> DataFrame:
    c = texts(spark, d).select("doc_id", T.clean_whitespace("text").alias("c"))
    return c.select("doc_id", F.length("c").cast("long").alias("n"), F.md5("c").alias("md5"))


@query(f"SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, sentence FROM ({_SENTS})")
def split_sentences(spark: SparkSession, d: str) -> DataFrame:
    return extraction.sentence_rows(texts(spark, d))


@query(f"SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, row_number() OVER (ORDER BY doc_id, sent_no) - 1 AS id FROM ({_SENTS}) WHERE length(sentence) >= 5")
def sentence_ids(spark: SparkSession, d: str) -> DataFrame:
    sents = extraction.sentence_rows(texts(spark, d), least=5).select("doc_id", "sent_no")
    return ordering.global_index(sents, F.floor(F.col("doc_id") / 1000), ["doc_id", "sent_no"])


_WORDS = r"list_distinct(list_filter(regexp_split_to_array(lower(sentence), '[^\p{L}\p{N}]+'), lambda x: x <> ''))"
_N2N = f"""WITH w AS (SELECT doc_id, sent_no, unnest({_WORDS}) AS token FROM ({_SENTS})),
m AS (SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, lemma, token FROM w JOIN (SELECT DISTINCT lemma, token FROM {_LEX} WHERE lemma <> token) USING (token))"""


@query(f"{_N2N} SELECT * FROM m")
def n2n_extract(spark: SparkSession, d: str) -> DataFrame:
    sents = extraction.sentence_rows(texts(spark, d))
    return extraction.many_to_many(sents, extraction.lexicon(spark)).select("doc_id", "sent_no", "lemma", "token")


@query(f"{_N2N}, u AS (SELECT DISTINCT doc_id, sent_no, lemma FROM m) SELECT doc_id, sent_no, arg_min(lemma, md5(doc_id || '|' || sent_no || '|' || lemma)) AS lemma FROM u GROUP BY ALL")
def one_to_one_extract(spark: SparkSession, d: str) -> DataFrame:
    units = extraction.many_to_many(extraction.sentence_rows(texts(spark, d)), extraction.lexicon(spark))
    return sampling.one_of(units.select("doc_id", "sent_no", "lemma").distinct(), ["doc_id", "sent_no"], "lemma")


@query(
    f"""SELECT CAST(len(list_intersect({_WORDS}, (SELECT list(DISTINCT token) FROM {_LEX} WHERE lemma NOT IN ('be', 'have')))) AS INTEGER) AS n_verbs, count(*) AS n
FROM ({_SENTS}) WHERE length(sentence) >= 5 GROUP BY 1"""
)
def verbs_per_sentence_hist(spark: SparkSession, d: str) -> DataFrame:
    return extraction.verbs_per_sentence(extraction.sentence_rows(texts(spark, d), least=5), extraction.lexicon(spark))


_CLAUSES = r"list_filter(list_transform(regexp_split_to_array(sentence, '[,;:]\s+|\s+(?:and|but|which|who|while|because)\s+'), lambda x: trim(x)), lambda x: length(x) >= 5)"


@query(
    rf"""WITH c AS (SELECT unnest({_CLAUSES}) AS clause FROM ({_SENTS}) WHERE length(sentence) >= 5)
SELECT CAST(len(list_intersect(list_distinct(list_filter(regexp_split_to_array(lower(clause), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')), (SELECT list(DISTINCT token) FROM {_LEX} WHERE lemma NOT IN ('be', 'have')))) AS INTEGER) AS n_verbs, count(*) AS n
FROM c GROUP BY 1"""
)
def verbs_per_clause_hist(spark: SparkSession, d: str) -> DataFrame:
    """As verbs_per_sentence_hist, over the clauses of sentences."""
    clauses = extraction.sentence_rows(texts(spark, d), least=5).select(F.explode(tagging.clauses("sentence")).alias("sentence"))
    return extraction.verbs_per_sentence(clauses, extraction.lexicon(spark))


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("source", F.concat(F.lit("s"), (F.col("user_id") % 20).cast("string")))


_EV = "(SELECT *, 's' || CAST(user_id % 20 AS VARCHAR) AS source FROM events)"


@query(f"SELECT source, event_type, count(*) AS n FROM {_EV} GROUP BY ALL")
def lu_source_counts(spark: SparkSession, d: str) -> DataFrame:
    return sampling.pair_counts(_events(spark, d), "source", "event_type")


@query(f"SELECT event_type, source, count(*) AS n FROM {_EV} GROUP BY GROUPING SETS ((event_type), (source), ())")
def lu_source_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    return sampling.totals(_events(spark, d), "source", "event_type")


@query(
    f"""WITH e AS (SELECT * FROM {_EV}), c AS (SELECT source, event_type, count(*) AS n FROM e GROUP BY ALL), k AS (SELECT count(DISTINCT source) AS k FROM e)
SELECT event_id, source, event_type FROM e JOIN c USING (source, event_type), k WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < 200.0::DOUBLE / k / n"""
)
def balanced_sample_hash(spark: SparkSession, d: str) -> DataFrame:
    return sampling.balanced(_events(spark, d), "source", "event_type", F.col("event_id").cast("string"), 200).select("event_id", "source", "event_type")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_difference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id").subtract(table(spark, d, "labels").select("doc_id"))


@query("SELECT doc_id FROM documents WHERE lang = 'en' INTERSECT SELECT doc_id FROM labels WHERE quality = 1")
def set_intersection(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("lang = 'en'").select("doc_id").intersect(table(spark, d, "labels").where("quality = 1").select("doc_id"))


@query("SELECT DISTINCT key FROM (SELECT event_type AS key FROM events UNION ALL SELECT lang FROM documents UNION ALL SELECT role FROM conversations)")
def key_union(spark: SparkSession, d: str) -> DataFrame:
    keys = [table(spark, d, t).select(F.col(c).alias("key")) for t, c in (("events", "event_type"), ("documents", "lang"), ("conversations", "role"))]
    return keys[0].unionByName(keys[1]).unionByName(keys[2]).distinct()


@query("SELECT lang, approx AS n_sources, n FROM (SELECT lang, count(DISTINCT source) AS approx, count(*) AS n FROM documents GROUP BY lang)")
def distinct_sources(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("lang").agg(F.countDistinct("source").alias("n_sources"), F.count("*").alias("n"))


@query()
def pos_tagged_verbs(spark: SparkSession, d: str) -> DataFrame:
    """Verbs of the documents by lemma, from the rule tagger."""
    each = texts(spark, d).select("doc_id", F.explode(tagging.verb_counts("text")).alias("t"))
    return each.groupBy("t.lemma").agg(F.sum("t.n").alias("n"), F.countDistinct("doc_id").alias("df"))


@query()
def grammar_chunks(spark: SparkSession, d: str) -> DataFrame:
    sents = extraction.sentence_rows(texts(spark, d))
    return tagging.grammar_extract(sents, extraction.lexicon(spark)).select("doc_id", "sent_no", "chunk", "lemma", "token")


@query()
def clause_extract(spark: SparkSession, d: str) -> DataFrame:
    return tagging.clause_extract(extraction.sentence_rows(texts(spark, d)), extraction.lexicon(spark)).select("doc_id", "sent_no", "clause", "lemma")
