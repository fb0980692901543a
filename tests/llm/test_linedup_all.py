"""Line dedup against alignment with every earlier document."""

from __future__ import annotations

import random

import numpy as np
import pytest

from factloom.llm import linedup as L


def against_all(rows: list[tuple], least: int) -> dict:
    """Removed lines by doc_id: each document against all earlier ones that differ from it."""
    name, seen, out = {}, [], {}
    for d, t in sorted(rows):
        text = [x for x in t.split("\n") if x.strip()]
        h, w = np.array([name.setdefault(x, len(name) + 1) for x in text], np.uint64), np.array([len(x.split()) for x in text])
        if any(np.array_equal(h, a) for a in seen):
            out[d] = len(h)
            continue
        out[d] = len({i for a in seen for i in L.common_blocks(a, h, w, least)})
        seen.append(h)
    return out


def test_reversed_passages(spark):
    """The first holder has the two passages in the other order, so only one aligns there; the second holder has the other one alone."""
    a, b = "a passage of six words here", "another passage of seven words is there"
    rows = [(1, f"{a}\nx\n{b}"), (2, f"y\n{a}"), (3, f"z\n{b}"), (4, f"u\n{b}\nv\n{a}\nw")]
    got = {r.doc_id: r.removed_lines for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == against_all(rows, 5) and got[4] == 2


@pytest.mark.parametrize("block", [10_000, 3])
def test_all_earlier(spark, monkeypatch, block):
    rnd = random.Random(7)
    pool = [f"line {i} has " + "word " * n for i, n in enumerate([0, 0, 0, 1, 2, 3, 4, 5] * 3)] + ["one", "two", "three w", ""]
    rows = [(d, "\n".join(rnd.choice(pool) if rnd.random() < 0.7 else f"own {d} {i} w w w" for i in range(rnd.randint(1, 14)))) for d in range(250)]
    monkeypatch.setattr(L.removals, "__defaults__", (block,))
    got = {r.doc_id: r.removed_lines for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == against_all(rows, 5)


def test_windows_cover_blocks():
    rnd = random.Random(3)
    for _ in range(300):
        n = rnd.randint(1, 12)
        h = np.array([rnd.choice([0, *range(1, 30)]) for _ in range(n)], np.uint64)
        w = np.where(h == 0, 0, np.array([rnd.randint(1, 7) for _ in range(n)]))
        a, b, _ = L.windows(h, w, 5)
        held = np.flatnonzero(h)
        for i in range(len(held)):
            for j in range(i + 1, len(held) + 1):
                if w[held[i:j]].sum() >= 5:
                    inside = [(x, y) for x, y in zip(a, b) if x >= held[i] and y <= held[j - 1] + 1]
                    assert set(held[i:j].tolist()) <= {k for x, y in inside for k in range(x, y)}
