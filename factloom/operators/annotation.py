"""Annotation round trip: units to a wide sheet, judgements back to answers."""

from __future__ import annotations

from html import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def positions(df: DataFrame, key: list[str], position: list[str], value: str) -> DataFrame:
    """key, position (from 0 in the order of the columns `position`) and value of every row; nulls are left out."""
    at = (F.row_number().over(W.partitionBy(*key).orderBy(*position)) - 1).alias("position")
    return df.select(*key, at, F.col(value).alias("value")).where("value is not null")


def units(df: DataFrame, key: list[str], position: list[str], value: str, width: int | None, prefix: str) -> DataFrame:
    """One row for each key with columns prefix_00, prefix_01, ...: as many as the largest key has rows, found by a small aggregate; or the
    first ones only, where width is stated."""
    if width is None:
        width = df.groupBy(*key).count().agg(F.max("count")).first()[0] or 0
    at = F.row_number().over(W.partitionBy(*key).orderBy(*position)) - 1
    rows = df.withColumn("_at", at)
    columns = [F.max(F.when(F.col("_at") == i, F.col(value))).alias(f"{prefix}_{i:02d}") for i in range(width)]
    return rows.groupBy(*key).agg(*columns) if columns else rows.select(*key).distinct()


def unpivot(df: DataFrame, key: list[str], prefix: str, width: int) -> DataFrame:
    """key, position and value of columns prefix_00 ... ; nulls are left out."""
    pairs = F.array(*[F.struct(F.lit(i).alias("position"), F.col(f"{prefix}_{i:02d}").alias("value")) for i in range(width)])
    return df.select(*key, F.inline(pairs)).where("value is not null")


def majority(judgements: DataFrame, key: list[str], answer: str) -> DataFrame:
    """The most frequent answer of each key and its votes; empty and None don't count; ties go to the least answer."""
    votes = judgements.where(F.col(answer).isNotNull() & ~F.col(answer).isin("", "None")).groupBy(*key, answer).agg(F.count("*").alias("votes"))
    best = F.max(F.struct(F.col("votes"), (-F.col("_rank")).alias("_rank"), F.col(answer)))
    ranked = votes.withColumn("_rank", F.row_number().over(W.partitionBy(*key).orderBy(answer)))
    return ranked.groupBy(*key).agg(best.alias("_b")).select(*key, f"_b.{answer}", "_b.votes")


def constant(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Keys in which some of the columns is not constant: what a check of units must find empty."""
    return df.groupBy(key).agg(*[F.countDistinct(F.coalesce(F.col(c).cast("string"), F.lit("\0"))).alias(c) for c in columns]).where(" or ".join(f"`{c}` > 1" for c in columns))


def gold(text: Column) -> Column:
    """Answers split at new lines; none is null."""
    return F.transform(F.split(text, "\n"), lambda x: F.when(F.lower(F.trim(x)) != "none", F.trim(x)))


def gold_accuracy(df: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    return df.agg(F.avg(F.coalesce(F.array_contains(actual, predicted), F.lit(False)).cast("double")).alias("accuracy"), F.count("*").alias("n"))


def form(columns: list[str]) -> str:
    """The annotators' form for a sheet with columns fe_NN and chunk_NN: each chunk with a choice of all elements."""
    elements = [c for c in sorted(columns) if c.startswith("fe_")]
    chunks = [c for c in sorted(columns) if c.startswith("chunk_")]
    choice = "".join(f'<cml:radio label="{{{{{escape(e)}}}}}"/>' for e in elements)
    return "\n".join(f'{{% if {c} %}}<cml:radios name="answer_{c}" label="{{{{{escape(c)}}}}}">{choice}<cml:radio label="None"/></cml:radios>{{% endif %}}' for c in chunks)
