"""Shuffles of packed arrays: a task sends each partition a few binary rows in place of millions of small ones."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession


def _murmur_int(value: int, seed: int = 42) -> int:
    """Spark's hash of an int column."""
    m = 0xFFFFFFFF
    k = value * 0xCC9E2D51 & m
    k = (k << 15 | k >> 17) & m
    h = seed ^ (k * 0x1B873593 & m)
    h = (h << 13 | h >> 19) & m
    h = (h * 5 + 0xE6546B64) & m
    h ^= 4
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = ((h ^ h >> shift) * by) & m
    h ^= h >> 16
    return h - 2**32 if h >= 2**31 else h


def part_keys(n: int) -> np.ndarray:
    """For each of n partitions an int that Spark's hash partitioning sends there, so that none gets two and none is empty."""
    keys, value = {}, 0
    while len(keys) < n:
        keys.setdefault(_murmur_int(value) % n, value)
        value += 1
    return np.array([keys[r] for r in range(n)], np.int32)


def to_parts(df: DataFrame, n: int) -> DataFrame:
    """df, whose column part holds values of part_keys(n), in n partitions."""
    return df.repartition(n, "part")


def shuffle_partitions(spark: SparkSession, rows: float = 0, rows_each: float = 4e6) -> int:
    """Partitions for so many packed rows, and no fewer than a handful for each run."""
    return max(12, int(np.ceil(rows / rows_each)))


def split_by(part: np.ndarray, n: int, *arrays: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """The arrays' rows of each part, in their order."""
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(1, n))
    return list(zip(*(np.split(a[order], ends) for a in arrays), strict=True))
