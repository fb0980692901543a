from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm import blocks as B
from factloom.llm import parts

TEXT = st.text(alphabet="ab cÉé\n\t\x0b\x1c ,", max_size=30)


@settings(deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8))
def test_words(texts):
    seen = {}
    for b in B.blocks(pa.array(texts, pa.string()), most=20):
        h = b.hashes()
        for i in range(b.n):
            words = [bytes(b.buf[s:e]) for s, e in zip(b.start[b.cut[i] : b.cut[i + 1]], b.end[b.cut[i] : b.cut[i + 1]], strict=True)]
            assert words == (texts[b.first + i] or "").encode().split()
            for w, x in zip(words, h[b.cut[i] : b.cut[i + 1]].tolist(), strict=True):
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_long_word_and_grams():
    one = B.span_hashes(np.frombuffer(b"ab" * 2_000_000, np.uint8), np.array([0]), np.array([4_000_000]))
    two = B.span_hashes(np.frombuffer(b"ab" * 2_000_000 + b" ", np.uint8), np.array([0]), np.array([4_000_000]))
    assert one[0] == two[0]
    (b,) = B.blocks(pa.array(["a b c", "", "a b", "x"]))
    g, valid = B.grams(b.hashes(), b.cut, 2)
    assert valid.tolist() == [True, True, False, True, False, False]
    assert g[0] == g[3] != g[1]


def test_parts(spark):
    from pyspark.sql import functions as F

    keys = parts.part_keys(13)
    df = spark.createDataFrame([(int(k),) for k in keys], "part int")
    assert sorted(r[0] for r in df.select(F.pmod(F.hash("part"), F.lit(13))).collect()) == list(range(13))


def test_salted_join(spark):
    from pyspark.sql import functions as F

    from factloom.llm.shared import salted_join

    big = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 7).alias("k"), "id")
    small = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = sorted(tuple(r) for r in salted_join(big, small, "k", F.col("id"), hot_rows=100).select("k", "id", "v").collect())
    assert got == sorted(tuple(r) for r in big.join(small, "k").select("k", "id", "v").collect())


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 6)), max_size=8), st.integers(0, 30), st.integers(1, 6))
def test_taken(spans, a, n):
    from factloom.llm.spans import Taken

    spans = [(s, s + k) for s, k in spans]
    assert Taken(spans).overlaps(a, a + n) == any(s < a + n and a < e for s, e in spans)
