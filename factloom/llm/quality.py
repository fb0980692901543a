"""Quality rules: an isolation forest over statistics of rules, with its threshold set on labelled rows.

The statistics of a text take one pass without a shuffle. They are written (about 150 bytes a document), so that the
forest and its threshold, which need the labels, don't read the texts again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factloom.llm.blocks import LEAD, SPACE, Block, U, blocks, grams, mix, span_hashes, text_of
from factloom.llm.shared import smallest_hashes, start, written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_lower", "n_digits", "n_marks", "n_short")
_SYMBOL, _UPPER, _LOWER_, _DIGIT, _MARK = (np.zeros(256, bool) for _ in range(5))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[65:91] = True
_LOWER_[97:123] = True
_DIGIT[48:58] = True
_MARK[list(b".,;:!?")] = True
STATS_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS + EXTRA)


def _salted(b: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix(b ^ (doc.astype(U) * U(0x9E3779B97F4A7C15)))


def dup_lines(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each text: lines with a word, and how many of them equal an earlier line."""
    newline = np.flatnonzero(b.buf == 10)
    cuts = np.unique(np.concatenate([b.off, newline, newline + 1]))
    start, end = cuts[:-1], cuts[1:]
    n_words = np.searchsorted(b.start, end) - np.searchsorted(b.start, start)
    start, end = start[n_words > 0], end[n_words > 0]
    doc = np.searchsorted(b.off, start, "right") - 1
    lines = np.bincount(doc, minlength=b.n)
    key = _salted(span_hashes(b.buf, start, end), doc)
    _, at = np.unique(key, return_index=True)
    return lines, lines - np.bincount(doc[at], minlength=b.n)


def repeat_words(b: Block, n: int = 3) -> np.ndarray:
    """For each text: words in n-word windows that it holds twice or more."""
    g, valid = grams(b.hashes(), b.cut, n)
    at = np.flatnonzero(valid)
    doc = np.repeat(np.arange(b.n), np.diff(b.cut))[at]
    key = _salted(g[at], doc)
    s = np.sort(key)
    twice = s[1:][s[1:] == s[:-1]]
    covered = np.zeros(len(g) + n, bool)
    if len(twice):
        twice = np.unique(twice)
        i = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        hit = at[twice[i] == key]
        for k in range(n):
            covered[hit + k] = True
    return b.per_doc(covered[: len(g)], b.cut)


def text_stats(column: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS and EXTRA of each text; null is empty."""
    parts: dict[str, list[np.ndarray]] = {c: [] for c in COUNTS + EXTRA}
    for b in blocks(column):
        lead = LEAD[b.buf]
        lines, dup = dup_lines(b)
        wide = np.zeros(len(b.buf) + 1, np.int64)  # code points up to each byte
        np.cumsum(lead, out=wide[1:])
        short = (wide[b.end] - wide[b.start]) <= 3
        for c, v in {
            "n_words": np.diff(b.cut), "word_chars": b.per_doc(lead & ~SPACE[b.buf]), "n_symbols": b.per_doc(_SYMBOL[b.buf]), "n_dup_lines": dup,
            "n_repeat_words": repeat_words(b), "n_lines": lines, "n_upper": b.per_doc(_UPPER[b.buf]), "n_lower": b.per_doc(_LOWER_[b.buf]),
            "n_digits": b.per_doc(_DIGIT[b.buf]), "n_marks": b.per_doc(_MARK[b.buf]), "n_short": b.per_doc(short, b.cut),
        }.items():
            parts[c].append(v)
    return {c: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for c, v in parts.items()}


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).cast(pa.int64()), **{c: pa.array(v) for c, v in text_stats(batch.column(1)).items()}})


def rule_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the rule statistics of every whole text, one row for each row of docs."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_stats, STATS_SCHEMA)


def features(s: pd.DataFrame) -> np.ndarray:
    """What the forest sees: rates, which don't grow with the length of a text."""
    w = np.maximum(s.n_words.to_numpy(float), 1)
    letters = np.maximum((s.n_upper + s.n_lower).to_numpy(float), 1)
    return np.column_stack([
        s.word_chars / w, s.n_symbols / w, s.n_dup_lines / np.maximum(s.n_lines, 1), s.n_repeat_words / w,
        s.n_upper / letters, s.n_digits / w, s.n_marks / w, s.n_short / w,
    ]).astype(float)


class IsolationForest:
    """Trees of random splits fitted on ordinary rows; a row's anomaly score is 2 ** (-mean path length / expected path length).

    Columns are taken as log(1 + deviation in standard deviations of the fitted rows). A split lies anywhere in the node's cell of the
    box that holds all rows shown to fit(), not only between the node's own rows, so that a cell without ordinary rows ends early.
    """

    def __init__(self, trees: int = 100, sample: int = 256, seed: int = 7):
        self.trees, self.sample, self.seed = trees, sample, seed

    def scaled(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.middle) / self.spread
        return np.sign(z) * np.log1p(np.abs(z))

    @staticmethod
    def expected(n: np.ndarray | float) -> np.ndarray:
        """Mean path length of an unsuccessful search in a binary tree of n rows."""
        n = np.asarray(n, float)
        safe = np.maximum(n, 2)
        c = 2 * (np.log(np.maximum(safe - 1, 1)) + 0.5772156649) - 2 * (safe - 1) / safe
        return np.where(n > 2, c, np.where(n == 2, 1.0, 0.0))

    def fit(self, x: np.ndarray, box: np.ndarray | None = None) -> IsolationForest:
        rng = np.random.default_rng(self.seed)
        self.middle, self.spread = np.median(x, 0), x.std(0) + 0.01
        x, box = self.scaled(x), self.scaled(x if box is None else np.vstack([x, box]))
        size = min(self.sample, len(x))
        self.height = max(1, int(np.ceil(np.log2(max(size, 2)))))
        nodes = 2 ** (self.height + 1) - 1
        self.column = np.zeros((self.trees, nodes), np.int16)
        self.split = np.full((self.trees, nodes), np.nan)
        self.rows = np.zeros((self.trees, nodes))
        self.norm = float(self.expected(size)) or 1.0
        for t in range(self.trees):
            todo = [(0, rng.choice(len(x), size, replace=False), 0, box.min(0), box.max(0))]
            while todo:
                node, rows, depth, lo, hi = todo.pop()
                self.rows[t, node] = len(rows)
                usable = np.flatnonzero(hi > lo)
                if depth >= self.height or len(rows) <= 1 or not len(usable):
                    continue
                c = rng.choice(usable)
                at = rng.uniform(lo[c], hi[c])
                self.column[t, node], self.split[t, node] = c, at
                left = x[rows, c] < at
                below, above = hi.copy(), lo.copy()
                below[c] = above[c] = at
                todo += [(2 * node + 1, rows[left], depth + 1, lo, below), (2 * node + 2, rows[~left], depth + 1, above, hi)]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        x = self.scaled(x)
        total, every = np.zeros(len(x)), np.arange(len(x))
        for t in range(self.trees):
            node, depth = np.zeros(len(x), int), np.zeros(len(x))
            live = every
            for _ in range(self.height):
                at = self.split[t, node[live]]
                live = live[~np.isnan(at)]
                if not len(live):
                    break
                right = x[live, self.column[t, node[live]]] >= self.split[t, node[live]]
                node[live] = 2 * node[live] + 1 + right
                depth[live] += 1
            total += depth + self.expected(self.rows[t, node])
        return 2 ** (-total / self.trees / self.norm)


def threshold(score: np.ndarray, good: np.ndarray, most_wrong: float, rows: np.ndarray | None = None) -> float:
    """The score above which a row is rejected: of those that reject at most most_wrong of the good rows, the one that rejects
    most bad rows, midway to the next lower score; infinite where there are no good or no bad rows. rows: how many rows each entry stands for."""
    rows = np.ones(len(score)) if rows is None else rows
    if not rows[good].sum() or not rows[~good].sum():
        return float("inf")
    values, at = np.unique(score, return_inverse=True)
    cuts = np.append((values[1:] + values[:-1]) / 2, values[-1] + 1 / SCORE_BINS)
    wrong, caught = (1 - np.cumsum(np.bincount(at[x], rows[x], len(values))) / rows[x].sum() for x in (good, ~good))
    value = np.where(wrong <= most_wrong + 1e-12, caught - wrong, -1)
    return float(cuts[np.flatnonzero(value == value.max())[-1]])


#: Scores of labelled rows are counted in bins of this width's inverse.
SCORE_BINS = 10_000
#: Up to so many labelled doc_ids are broadcast to find their texts.
BROADCAST_IDS = 4_000_000


class Judge:
    """Base rules, and a forest with the score from which it rejects; without a forest the rules alone."""

    def __init__(self, seen: pd.DataFrame, trees: int, sample: int, min_words: int, seed: int):
        self.min_words, self.forest, self.limit = min_words, None, float("inf")
        good = seen.quality.to_numpy() > 0
        if good.any() and not good.all():
            x = features(seen)
            self.forest = IsolationForest(trees, sample, seed).fit(x[good], x)

    def __call__(self, s: pd.DataFrame) -> pd.DataFrame:
        s["base_failed"] = (s.n_words < self.min_words) | (100 * s.n_repeat_words > 50 * s.n_words)
        s["anomaly"] = self.forest.score(features(s)) if self.forest is not None else 0.0
        s["kept"] = ~s.base_failed & (s.anomaly <= self.limit)
        return s


def calibrated(stats: DataFrame, labels: DataFrame, trees: int, sample: int, fit_rows: int, most_wrong: float, min_words: int, seed: int) -> Judge:
    """A forest fitted on a bounded sample of the labelled rows that pass the base rules, and its threshold from the scores of all of them."""
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    known = written(stats.where(~base).join(marks, "doc_id"), "labelled-stats")
    seen = smallest_hashes(known, "doc_id", fit_rows).orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS, *EXTRA).limit(fit_rows)
    judge = Judge(seen.toArrow().to_pandas(), trees, sample, min_words, seed)
    if judge.forest is not None:
        forest = judge.forest

        def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for s in batches:
                yield pd.DataFrame({"bin": np.floor(forest.score(features(s)) * SCORE_BINS).astype(np.int64), "good": s.quality.to_numpy() > 0})

        bins = known.mapInPandas(scored, "bin long, good boolean").groupBy("bin", "good").count().toPandas()  # 2 * SCORE_BINS rows at most
        judge.limit = threshold((bins["bin"].to_numpy() + 0.5) / SCORE_BINS, bins["good"].to_numpy(bool), most_wrong, bins["count"].to_numpy(float))
    return judge


def quality_rules(
    docs: DataFrame, labels: DataFrame, trees: int = 200, sample: int = 1024, fit_rows: int = 20_000, most_wrong: float = 0.002,
    min_words: int = 50, seed: int = 7,
) -> DataFrame:
    """One row for each row of docs: its rule counts, base_failed, the forest's score, and kept.

    The forest is fitted on labelled good rows that pass the base rules, those fit_rows labelled ones with the smallest hash of doc_id (a documented
    bound); its threshold is set on all labelled rows that pass, by their scores to 1 / SCORE_BINS. Of a doc_id with several labels the worst counts.
    A text of any length is counted whole. A null text is empty, so it fails the base rules; a row with a null doc_id has statistics but no label; repeated rows get
    equal verdicts; with no good or no bad labelled row nothing is rejected beyond the base rules; no documents give no rows.
    Other columns of docs and labels are not read.
    """
    start(docs)
    stats = written(rule_stats(docs), "rule-stats")
    judge = calibrated(stats, labels, trees, sample, fit_rows, most_wrong, min_words, seed)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from map(judge, batches)

    out = stats.mapInPandas(judged, STATS_SCHEMA + ", base_failed boolean, anomaly double, kept boolean")
    return out.select("doc_id", *COUNTS, "base_failed", "kept", "anomaly")


def keep_rows(
    docs: DataFrame, labels: DataFrame, trees: int = 200, sample: int = 1024, fit_rows: int = 20_000, most_wrong: float = 0.002,
    min_words: int = 50, seed: int = 7,
) -> DataFrame:
    """The rows of docs that quality_rules keeps, with their columns. Statistics are worked out for labelled rows, to fit and calibrate on, and then
    for each row where it is judged, so that texts are not shuffled. Cases are as in quality_rules."""
    start(docs)
    named = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Beyond the bound statistics of all rows are worked out first, and only those meet the labels.
    few = named.count() <= BROADCAST_IDS
    some = rule_stats(rows.join(F.broadcast(named), "doc_id", "left_semi")) if few else rule_stats(rows)
    judge = calibrated(written(some, "rule-stats"), labels, trees, sample, fit_rows, most_wrong, min_words, seed)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdict = judge(pd.DataFrame(text_stats(text_of(batch.column(0))))).kept
            yield batch.filter(pa.array(verdict.to_numpy(bool)))

    rows = docs.select(F.struct(*docs.columns).alias("row"))
    rows = rows.mapInArrow(kept, StructType(rows.schema.fields))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])
