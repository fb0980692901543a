"""Copies of a text are evidence once."""

from __future__ import annotations

import random

import numpy as np

from factloom.llm import secrets as S


def test_copies_count_once(spark):
    """A hot text whose neighbours look random doesn't hide the random tokens of other texts."""
    rnd = random.Random(1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    token = lambda: "".join(rnd.choice(letters + "0123456789") for _ in range(28))
    words = ["the", "and", "tion", "ing", "there", "was", "once", "upon", "time"]
    prose = lambda: " ".join(rnd.choice(words) for _ in range(40))
    rows = [(i, f"{prose()} {token()} {prose()}") for i in range(300)]
    noise = lambda: " ".join("".join(rnd.choice(letters) for _ in range(9)) for _ in range(12))
    hot = f"{noise()} {token()} {noise()}"
    alone = {r.doc_id: r.n_random for r in S.secret_scan(spark.createDataFrame([*rows, (300, hot)], "doc_id long, text string")).collect()}
    got = {r.doc_id: r.n_random for r in S.secret_scan(spark.createDataFrame([*rows, *[(300 + i, hot) for i in range(600)]], "doc_id long, text string")).collect()}
    assert [got[i] for i in range(301)] == [alone[i] for i in range(301)]
    assert np.mean([got[i] > 0 for i in range(300)]) > 0.8
    assert len({got[300 + i] for i in range(600)}) == 1
