"""The operators' queries, with production parameters over whole tables, and SQL where it can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import jaccard, mixing, warc
from factloom.llm.decontaminate import leaks
from factloom.llm.linedup import dedup_lines
from factloom.llm.lm import scores
from factloom.llm.mixing import source_mix
from factloom.llm.pii import find_pii
from factloom.llm.pieces import token_counts
from factloom.llm.quality import quality_rules
from factloom.llm.secrets import secret_scan
from factloom.session import table

#: A file of base64 tokens and ranks; public tokenizers' files are kept outside the repository.
VOCABULARY = os.environ.get("FACTLOOM_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "n_lines", "removed_lines", "n_words", "removed_words")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "n_similar", "component_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), VOCABULARY)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_line_dedup, op2_decontamination, op3_lm_scores, op4_source_mix, op5_warc, op6_secret_scan, op7_pii, op8_quality_rules, op9_jaccard_join, op10_token_counts,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op4_source_mix": mixing.SQL, "op5_warc": warc.SQL, "op9_jaccard_join": jaccard.SQL}
