"""A pipeline over documents: quality rules, line dedup, near duplicates, benchmark decontamination and mixing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last return the columns of documents.

Cases: what the operators state holds for their stages. Null or empty texts fail the quality rules, and pass the other stages untouched; rows of a null doc_id
and repeated rows are judged each; an empty table gives an empty one; columns besides those of documents pass, except mixing's copy and finish.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.decontaminate import decontaminate
from factloom.llm.jaccard import similar_rows
from factloom.llm.linedup import SIZES, dedup_lines
from factloom.llm.mixing import mixed
from factloom.llm.quality import keep_rows
from factloom.llm.shared import written
from factloom.session import ship, table

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules (fewer than 50 words, half of them in repeated windows), or that the isolation forest finds anomalous, go. See quality.keep_rows."""
    ship(spark)
    return keep_rows(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Aligned common blocks of earlier documents are deleted; documents of which nothing is left go. n_chars follows
    the text. Of equal texts the first doc_id keeps its lines, null last. See linedup.dedup_lines."""
    ship(spark)
    out = dedup_lines(docs)
    out = out.where((F.col("removed_lines") == 0) | (F.col("removed_lines") < F.col("n_lines"))).drop(*SIZES)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the smallest doc_id stays; documents without words are linked with nothing and stay.
    See jaccard.similar_rows."""
    ship(spark)
    return similar_rows(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or an edited copy of one, go; without items all stay. See decontaminate.decontaminate."""
    ship(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix, as often as it takes them, up to three times; those without words are never taken. See mixing.mixed."""
    ship(spark)
    return mixed(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
]

#: The forest, the alignments and the patience diff have no SQL; the README says what the tests compare.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
