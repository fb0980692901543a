"""Balanced sampling of sentences over lexical units and sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_fraction(key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone, in place of a random one."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def pair_counts(df: DataFrame, source: str, unit: str) -> DataFrame:
    return df.groupBy(source, unit).agg(F.count("*").alias("n"))


def balanced(df: DataFrame, source: str, unit: str, key: Column, per_unit: int) -> DataFrame:
    """Rows kept with probability (per_unit / number of sources) / rows of their source and unit. Counts are joined, and are small."""
    by = pair_counts(df, source, unit)
    n_sources = by.agg(F.countDistinct(source).alias("n_sources"))
    p = by.crossJoin(F.broadcast(n_sources)).select(source, unit, (F.lit(float(per_unit)) / F.col("n_sources") / F.col("n")).alias("p"))
    return df.join(p, [source, unit]).where(hash_fraction(key) < F.col("p")).drop("p")


def totals(df: DataFrame, source: str, unit: str) -> DataFrame:
    """Counts by unit, by source and in all, from one pass."""
    by = pair_counts(df, source, unit)
    return by.groupingSets([[F.col(unit)], [F.col(source)], []], F.col(unit), F.col(source)).agg(F.sum("n").alias("n"))


def one_of(df: DataFrame, group: list[str], candidate: str) -> DataFrame:
    """One candidate of each group, the one with the least hash: a choice that reruns repeat."""
    pick = F.md5(F.concat_ws("|", *group, candidate))
    return df.groupBy(*group).agg(F.min_by(candidate, F.struct(pick, F.col(candidate))).alias(candidate))
