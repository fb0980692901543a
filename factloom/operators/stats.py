"""Corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_counts(df: DataFrame, source: Column, missing: str = "_skipped_") -> DataFrame:
    """Rows by source; empty or null sources count under `missing`."""
    return df.groupBy(F.coalesce(F.nullif(source, F.lit("")), F.lit(missing)).alias("source")).agg(F.count("*").alias("n"))


def source_share(df: DataFrame, source: Column, least: float = 0.01) -> DataFrame:
    """Sources with a share of at least `least`, and a row Rest for the others together."""
    by = source_counts(df, source)
    total = by.agg(F.sum("n").alias("total"))
    each = by.crossJoin(F.broadcast(total)).withColumn("share", F.col("n") / F.col("total"))
    name = F.when(F.col("share") >= least, F.col("source")).otherwise(F.lit("Rest"))
    return each.groupBy(name.alias("source")).agg(F.sum("n").alias("n"), (F.sum("n") / F.max("total")).alias("share"))


def length_histogram(df: DataFrame, length: str, bins: int) -> DataFrame:
    """Rows by bucket of equal width from 0 to the largest length, which has a bucket of its own at the end."""
    top = df.agg(F.max(length).alias("top"))
    at = F.when(F.col("top") > 0, F.floor(F.col(length) * bins / F.col("top"))).otherwise(0).cast("long")
    return df.select(length).where(F.col(length).isNotNull()).crossJoin(F.broadcast(top)).groupBy(at.alias("bucket")).agg(F.count("*").alias("n"))


def counters(df: DataFrame, text: str, least: int) -> DataFrame:
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    return df.agg(
        F.count("*").alias("total"), F.count_if(n >= least).alias("with_text"), F.count_if(n > least).alias("longer"),
        (100.0 * F.count_if(n >= least) / F.count("*")).alias("percentage"), F.sum(F.when(n > least, n).otherwise(0)).cast("long").alias("characters"),
    )
