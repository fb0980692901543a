"""Sentences that hold lexical units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.text import sentences, tokens
from factloom.session import sized

#: (lemma, token, part of speech) of a small verb lexicon; tokens equal to their lemma are its base form.
LEXICON = (
    ("be", "is", "V"), ("be", "was", "V"), ("be", "are", "V"), ("be", "be", "V"), ("be", "ist", "V"), ("be", "est", "V"), ("be", "es", "V"),
    ("stand", "st", "V"), ("have", "ha", "V"), ("have", "have", "V"), ("end", "nd", "V"), ("end", "ende", "V"), ("come", "ver", "V"), ("come", "que", "V"),
)


def lexicon(spark: SparkSession, rows: Sequence[tuple[str, str, str]] = LEXICON) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rows], "lemma string, token string, pos string")


def sentence_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 1) -> DataFrame:
    """key, sent_no from 0, sentence."""
    each = docs.select(key, F.posexplode(sentences(text)).alias("sent_no", "sentence"))
    return each.where(F.length("sentence") >= least)


def many_to_many(sents: DataFrame, units: DataFrame, base_form: bool = False) -> DataFrame:
    """A row for each sentence, lexical unit and matching token; base forms match only if asked for."""
    units = units.select("lemma", "token").distinct()
    if not base_form:
        units = units.where("lemma <> token")
    words = sents.select("*", F.explode(F.array_distinct(tokens("sentence", lower=True))).alias("token"))
    return words.join(sized(units), "token")


def extract(docs: DataFrame, units: DataFrame, strategy: str = "n2n", key: str = "doc_id", text: str = "text", carry: Sequence[str] = ("url", "name"), bucket: Column | None = None, least: int = 1) -> DataFrame:
    """Sentences with lexical units by a strategy, with what documents carry: id, key, carry, sent_no, lu and text. n2n: a row for each unit and token, 121: one unit for a
    sentence, grammar: chunks of the grammar, syntactic: clauses of one unit. bucket: a coarse form of the key by which rows are numbered (see ordering.global_index)."""
    from factloom.operators import ordering, sampling, tagging

    carry = [c for c in carry if c in docs.columns]
    each = docs.select(key, *carry, F.posexplode(sentences(text)).alias("sent_no", "sentence")).where(F.length("sentence") >= least)
    keys = [key, *carry, "sent_no"]
    if strategy == "n2n":
        out = many_to_many(each, units).select(*keys, F.col("lemma").alias("lu"), F.col("sentence").alias("text"), "token")
    elif strategy == "121":
        found = many_to_many(each, units).select(*keys, "sentence", "lemma").distinct()
        out = sampling.one_of(found, [*keys, "sentence"], "lemma").select(*keys, F.col("lemma").alias("lu"), F.col("sentence").alias("text"), F.lit("").alias("token"))
    elif strategy == "grammar":
        out = tagging.grammar_extract(each, units).select(*keys, F.col("lemma").alias("lu"), F.col("chunk").alias("text"), "token")
    elif strategy == "syntactic":
        out = tagging.clause_extract(each, units).select(*keys, F.col("lemma").alias("lu"), F.col("clause").alias("text"), "token")
    else:
        raise ValueError(f"no strategy {strategy}")
    at = F.floor(F.col(key) / 1000) if bucket is None else bucket
    return ordering.global_index(out, at, [key, "sent_no", "text", "lu", "token"]).drop("token")


def verbs_per_sentence(sents: DataFrame, units: DataFrame, dropped: Sequence[str] = ("be", "have")) -> DataFrame:
    """How many sentences hold how many different verb tokens; units in `dropped` don't count."""
    verbs = units.where(~F.col("lemma").isin(*dropped)).agg(F.collect_set("token").alias("verbs"))
    n = F.size(F.array_intersect(tokens("sentence", lower=True), F.col("verbs")))
    return sents.crossJoin(F.broadcast(verbs)).groupBy(n.alias("n_verbs")).agg(F.count("*").alias("n"))
