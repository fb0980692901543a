"""Queries that state no cut, and neighbours in groups of copies."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from factloom.operators import annotation, learning


def test_units_keep_all(spark):
    rows = spark.createDataFrame([(k, i, f"v{i}") for k, n in ((1, 1), (2, 7), (3, 11)) for i in range(n)], "k int, i int, v string")
    wide = annotation.units(rows, ["k"], ["i"], "v", None, "chunk")
    assert wide.columns == ["k", *[f"chunk_{i:02d}" for i in range(11)]]
    assert {r.k: sum(x is not None for x in r) - 1 for r in wide.collect()} == {1: 1, 2: 7, 3: 11}
    assert sorted(map(tuple, annotation.positions(rows, ["k"], ["i"], "v").collect())) == sorted(map(tuple, rows.collect()))
    assert annotation.units(rows.limit(0), ["k"], ["i"], "v", None, "chunk").count() == 0


def test_knn_copies(spark):
    """Of 60 copies of one vector those of the least ids count, wherever they lie in a batch."""
    ids = list(range(1, 61))
    random.Random(4).shuffle(ids)
    rows = [(0, [0.0, 0.0], 9), *[(i, [1.0, 0.0], 1 if i <= 5 else 2) for i in ids], (99, [5.0, 5.0], 3)]
    base = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1)
    assert learning.knn(base.where(F.col("vec_id") == 0), base, 5).first().predicted == 1
    near = [(0, [0.0, 0.0], 9), *[(i, [1.0, 1e-4 * ((i * 7) % 60) / 60], 1 if i <= 5 else 2) for i in ids]]  # equal after rounding
    base = spark.createDataFrame(near, "vec_id long, embedding array<double>, label int").coalesce(1)
    assert learning.knn(base.where(F.col("vec_id") == 0), base, 5).first().predicted == 1
