from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls, empty and long texts, ties, repeated rows.
LONG = "long " * 30_000 + "x" * 50_000
EDGE = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1), (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1), (2, "The quick brown fox jumps over the lazy dog", None, None, None),
    (3, None, "en", "a", 0), (4, "", "en", "b", 0), (5, " \n\t\n ", "en", "b", 5), (None, "the quick brown fox", "en", "c", 3), (None, None, None, None, None), (6, LONG, "en", "c", len(LONG)),
    (7, "\n".join(f"line {i} of seven words in all" for i in range(40)), "en", "c", 2), (8, "\n".join(f"line {i} of seven words in all" for i in range(20, 60)), "en", "d", 2), (9, "word", "en", "d", 4), (10, "word", "en", None, 4),
]
EXTRA = "size long, target double, taken long, _sig int, row string, copy int, finish double, kept boolean, n_lines int, n_words int, _kept string, _source string, _key int, _id int, sig int"


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="session")
def clashing(edge):
    """The same rows with columns of names that operators use themselves."""
    from pyspark.sql import functions as F

    return edge.select("*", *[F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in EXTRA.split(", ")])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
