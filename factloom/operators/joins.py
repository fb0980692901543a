"""Joins of the engine: chains, disjunctive equalities, unambiguous keys, family links."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import batches
from factloom.session import sized


def left_chain(base: DataFrame, *others: tuple[DataFrame, list[str] | str]) -> DataFrame:
    """base left-joined with each table in turn; repeated keys multiply rows."""
    return reduce(lambda df, other: df.join(other[0], other[1], "left"), others, base)


def unambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that have one value only, and it; keys with two or more are banned."""
    found = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("_high"))
    return found.where(F.col(value) == F.col("_high")).drop("_high")


def resolve(df: DataFrame, known: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is known, with its value, and the rest: together all rows."""
    return df.join(known.select(key, value), key), df.join(known, key, "left_anti")


def label_alias_matches(labels: DataFrame, names: DataFrame, label: str, name: str, aliases: str) -> DataFrame:
    """labels joined with names on label = name or label in aliases, whatever the case: one equi-join over all names in place of an OR."""
    forms = F.array_distinct(F.transform(F.concat(F.array(name), F.coalesce(aliases, F.array().cast("array<string>"))), F.lower))
    every = names.withColumn("_form", F.explode(forms))
    return labels.withColumn("_form", F.lower(label)).join(every, "_form").drop("_form")


def overlapping_dates(a: DataFrame, b: DataFrame, key: str, parts: tuple[str, ...] = ("year", "month", "day"), carry: tuple[str, ...] = ()) -> DataFrame:
    """For pairs of a and b with one key: how many parts both have and are equal. Pairs stay within a key; carry: columns of b to keep."""
    right = b.select(key, *carry, *[F.col(p).alias(f"_{p}") for p in parts])
    same = reduce(lambda x, y: x + y, [F.coalesce((F.col(p) == F.col(f"_{p}")).cast("int"), F.lit(0)) for p in parts])
    return a.join(right, key).withColumn("matches", same).drop(*[f"_{p}" for p in parts])


def weighted_overlap(ours: Column, theirs: Column, weight: float = 1.0) -> Column:
    return F.size(F.array_intersect(ours, theirs)) * F.lit(weight)


def zipped(df: DataFrame, row: str, keys: str, values: str) -> DataFrame:
    """row, key and value of two arrays side by side, as long as the shorter; of a key that comes twice in a row the last value stays. For arrays of any length;
    text.zip_map is for those of a record. Keys are told apart where their row is; only of rows that share their name keys are brought together."""
    kinds = {c: df.schema[c].dataType for c in (row, keys, values)}
    schema = f"`{row}` {kinds[row].simpleString()}, key {kinds[keys].elementType.simpleString()}, value {kinds[values].elementType.simpleString()}"
    again = df.groupBy(row).agg(F.count("*").alias("_k")).where("_k > 1").select(F.col(row).alias("_again"))
    if again.isEmpty():
        return df.select(row, keys, values).mapInArrow(_last_values, schema)
    again = sized(again)
    same = F.col(row).eqNullSafe(F.col("_again"))
    n = F.least(F.size(keys), F.size(values))
    pairs = F.arrays_zip(F.slice(keys, 1, n).alias("key"), F.slice(values, 1, n).alias("value"))
    each = df.join(again, same, "left_semi").select(row, F.posexplode(pairs).alias("_i", "_p"))
    shared = each.groupBy(row, F.col("_p.key").alias("key")).agg(F.max_by("_p.value", "_i").alias("value"))
    return df.join(again, same, "left_anti").select(row, keys, values).mapInArrow(_last_values, schema).unionByName(shared)


def _last_values(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        at = 0
        for part in batches.parts(batch.column(1), pc.list_value_length(batch.column(1)), batches.TOKENS // 4):
            values = batch.column(2).slice(at, len(part))
            found = [dict(zip(k or (), v or (), strict=False)) for k, v in zip(part.to_pylist(), values.to_pylist(), strict=True)]
            owner = np.repeat(np.arange(at, at + len(part)), [len(x) for x in found])
            at += len(part)
            columns = {"key": pa.array([k for x in found for k in x], part.type.value_type), "value": pa.array([v for x in found for v in x.values()], values.type.value_type)}
            yield pa.RecordBatch.from_pydict({batch.schema.names[0]: batch.column(0).take(pa.array(owner)), **columns})


def contained(rows: DataFrame, sequence: str, part: str, name: str = "position") -> DataFrame:
    """rows with the first place (from 0) where the array `part` stands in the array `sequence`; null where it doesn't, or is empty."""
    n = F.size(part)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(sequence) - n, F.lit(0))), lambda i: F.slice(sequence, i + 1, n) == F.col(part))
    return rows.withColumn(name, F.when((n > 0) & (n <= F.size(sequence)), F.get(starts, F.lit(0))))


def last_of_chunk(elements: DataFrame, linked: DataFrame, key: str, chunk: str, order: str) -> DataFrame:
    """elements with the linked entity of their chunk, the last by order where several have it; null without one."""
    last = linked.groupBy(key, chunk).agg(F.max_by(F.struct(*[c for c in linked.columns if c not in (key, chunk)]), order).alias("link"))
    return elements.join(last, [key, chunk], "left")
