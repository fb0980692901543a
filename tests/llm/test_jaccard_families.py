"""Jaccard join: families of many different near copies, and the bounds that leave pairs out."""

from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factloom.llm import jaccard as J


def test_family(spark, monkeypatch):
    """All links of 500 different near copies are counted, though nothing that is written has a row for each."""
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    base = [rnd.choice(words) for _ in range(120)]
    rows = [(i, " ".join(rnd.choice(words) if rnd.random() < 0.07 else w for w in base)) for i in range(500)]
    rows += [(1000 + i, " ".join(rnd.choice(words) for _ in range(rnd.randint(40, 120)))) for i in range(100)]
    sizes = {}

    def written(df, name, plain=J.written):  # noqa: ANN001, ANN202
        out = plain(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(J, "written", written)
    got = {r.doc_id: r for r in J.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [{(a, b) for a, b in zip(t.split(), t.split()[1:], strict=False)} for _, t in rows]
    near = [sum(100 * len(x & y) >= 60 * len(x | y) for y in sets) - 1 for x in sets]
    assert [got[d].n_similar for d, _ in rows] == near and sum(near) > 100_000
    assert {got[d].component_id for (d, _), n in zip(rows, near, strict=True) if n} == {0}
    assert all(sizes[x] < 10 * len(rows) for x in ("candidates", "placed", "needed", "links")), sizes


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=4), st.lists(st.integers(1, 60), min_size=1, max_size=4))
def test_need_of_nodes(x, y):
    low, high = np.array([min(x), min(y)]), np.array([max(x), max(y)])
    bound = J.least_of_nodes(low, high, np.array([0]), np.array([1]), 60)[0]
    fits = [(a, b) for a in x for b in y if 100 * min(a, b) >= 60 * max(a, b)]
    assert all(bound <= J.least_common(np.array([a]), np.array([b]), 60)[0] for a, b in fits)


def test_need_after_drops(spark):
    """Whatever a linked pair's count loses in r blocks, it meets what is asked of any smaller need."""
    for r in (12, 45):
        need = np.arange(1, 400)
        left = need - r * J.dropped(need, r)
        asked = np.array([x.k for x in spark.range(1, 400).select(J.least_kept(F.col("id"), r).alias("k")).collect()])
        assert (np.maximum.accumulate(asked) <= left).all() and (asked > 0).all()


@settings(deadline=None, max_examples=100)
@given(st.sets(st.integers(0, 2**40), min_size=1, max_size=300), st.sets(st.integers(0, 2**40), max_size=300), st.sets(st.integers(0, 2**40), max_size=40))
def test_sketches(both, a, b):
    x, y = (np.array(sorted(both | s), np.uint64) for s in (a, b))
    assert J.differing(J.sketch(x), J.sketch(y)) <= len((both | a) ^ (both | b))
    assert J.differing(J.sketch(x), J.sketch(x)) == 0
