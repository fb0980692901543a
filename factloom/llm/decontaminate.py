"""Benchmark decontamination: rare n-gram seeds find passages, Smith-Waterman alignment scores them.

The benchmark is the stated query set: it is taken in blocks of about BLOCK_WORDS words (a longer item is a block with others before it), which
bounds what a task holds; a block's index is a file of the shared folder, and each block meets every document. A document's words are compared where they are: neither texts nor candidates are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factloom.llm.blocks import Block, U, blocks, grams, span_hashes, text_of
from factloom.llm.shared import loaded, start, stored

BLOCK_WORDS = 1_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_MASK_BITS = 22


def normal(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of a block without punctuation at their ends, in lower case (A-Z and Latin-1), the number of each text's
    first word, and which of the block's words they are; words of punctuation alone are left out."""
    buf = b.buf.copy()
    after = (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97) & (buf[:-1] == 0xC3)
    buf[1:][after] += 0x20
    start, end = b.start.copy(), b.end.copy()
    live = np.arange(len(start))
    while len(live):
        live = live[_PUNCT[buf[start[live]]]]
        start[live] += 1
        live = live[start[live] < end[live]]
    live = np.flatnonzero(start < end)
    while len(live):
        live = live[_PUNCT[buf[end[live] - 1]]]
        end[live] -= 1
        live = live[start[live] < end[live]]
    keep = np.flatnonzero(start < end)
    return span_hashes(buf, start[keep], end[keep]), np.searchsorted(keep, b.cut), keep


@dataclass
class Items:
    """Some benchmark items: the words of all, one after another, and their seeds."""

    ids: np.ndarray
    words: np.ndarray
    cut: np.ndarray
    n: int
    seeds: np.ndarray | None = None
    first: np.ndarray | None = None
    item: np.ndarray | None = None
    place: np.ndarray | None = None
    least: np.ndarray | None = None
    weight: np.ndarray | None = None
    sizes: tuple[int, ...] = ()

    def index(self, seed: np.ndarray, item: np.ndarray, place: np.ndarray) -> None:
        order = np.lexsort((place, item, seed))
        self.seeds, self.first = np.unique(seed[order], return_index=True)
        self.first = np.append(self.first, len(seed))
        self.item, self.place = item[order], place[order]

    @classmethod
    def of(cls, ids: list[int], texts: list[str | None], n: int) -> Items:
        words, sizes = [np.zeros(0, U)], []
        for b in blocks(pa.array(texts, pa.string()), lower=True):
            h, cut, _ = normal(b)
            words.append(h)
            sizes.append(np.diff(cut))
        out = cls(np.array(ids, np.int64), np.concatenate(words), np.append(0, np.cumsum(np.concatenate(sizes) if sizes else [])).astype(np.int64), n)
        size, seeds = np.diff(out.cut), []
        out.sizes = tuple(m for m in range(1, n + 1) if m == n or (size == m).any())
        for m in out.sizes:  # an item of fewer than n words is one seed
            g, valid = grams(out.words, out.cut, m)
            at = np.flatnonzero(valid)
            item = np.searchsorted(out.cut, at, "right") - 1
            ok = (size[item] == m) | (m == n)
            seeds.append((g[at[ok]], item[ok], (at - out.cut[item])[ok]))
        out.index(*(np.concatenate(x) for x in zip(*seeds, strict=True)))
        return out

    def rare(self, df: np.ndarray, rows: int, share: float, rare_share: float) -> None:
        """Keep the seeds that at most rare_share of the rows hold (and any that at most 2 hold), which count double; and of the others as
        many as make up `share` of the item's seeds, rarest first. That order is the item's own, so an item that very many documents hold
        keeps seeds too; only an item of fewer than n words has to be rare itself. least: what the different seeds of a passage have to count, 2, or 1 for an item of one seed."""
        of = np.repeat(np.arange(len(self.seeds)), np.diff(self.first))
        order = np.lexsort((self.place, df[of], self.item))
        item = self.item[order]
        start = np.searchsorted(item, np.arange(len(self.ids)))
        rank = np.arange(len(order)) - start[item]
        total = np.bincount(item, minlength=len(self.ids))
        rare = df <= max(2, rare_share * rows)
        short = np.diff(self.cut)[item] < self.n
        kept = order[((rank < np.maximum(np.ceil(total * share), 2)[item]) & ~short) | rare[of[order]]]
        self.least = np.minimum(2, total)
        weight = dict(zip(self.seeds[rare].tolist(), [2] * int(rare.sum()), strict=True))
        self.index(self.seeds[of[kept]], self.item[kept], self.place[kept])
        self.weight = np.array([weight.get(x, 1) for x in self.seeds.tolist()], np.int64)

    def mask(self) -> np.ndarray:
        out = np.zeros(1 << _MASK_BITS, bool)
        out[(self.seeds >> U(64 - _MASK_BITS)).astype(np.int64)] = True
        return out

    def hits(self, h: np.ndarray, cut: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of a block where a seed begins, and which seed."""
        places, seeds = [], []
        for m in self.sizes:
            g, valid = grams(h, cut, m)
            at = np.flatnonzero(valid & mask[(g >> U(64 - _MASK_BITS)).astype(np.int64)])
            i = np.searchsorted(self.seeds, g[at])
            ok = (i < len(self.seeds)) & (self.seeds[np.minimum(i, len(self.seeds) - 1)] == g[at]) if len(self.seeds) else np.zeros(len(at), bool)
            places.append(at[ok])
            seeds.append(i[ok])
        at, seed = np.concatenate(places), np.concatenate(seeds)
        order = np.argsort(at, kind="stable")
        return at[order], seed[order]


def smith_waterman(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each row of a with the same row of b (padded with different numbers): score, and where in b it starts
    and ends. All rows go along their anti-diagonals together; a cell is the score and, below it, where its alignment starts."""
    rows, m, w = len(a), a.shape[1], b.shape[1]
    shift, low = 32, (1 << 32) - 1
    one, two = (np.full((rows, m + 1), low, np.int64) for _ in range(2))
    best, end = np.full(rows, low, np.int64), np.zeros(rows, np.int64)
    for d in range(2, m + w + 1):  # cells (i, j), i + j = d, 1-based
        lo, hi = max(1, d - w), min(m, d - 1)
        i = np.arange(lo, hi + 1)
        j = d - i
        fresh = low - (j - 1)  # score 0, starts here; an earlier start is larger
        score = np.where(a[:, i - 1] == b[:, j - 1], MATCH, MISMATCH).astype(np.int64) << shift
        diagonal = two[:, lo - 1 : hi]
        diagonal = np.where(diagonal >> shift > 0, diagonal, fresh) + score
        gap = np.maximum(one[:, lo - 1 : hi], one[:, lo : hi + 1]) + (GAP << shift)
        cell = np.maximum(diagonal, gap)
        cell = np.where(cell >> shift > 0, cell, low - j)  # nothing yet
        new = np.full((rows, m + 1), low, np.int64)
        new[:, lo : hi + 1] = cell
        two, one = one, new
        top = cell.argmax(1)
        value = cell[np.arange(rows), top]
        better = value >> shift > best >> shift
        best[better], end[better] = value[better], j[top[better]]
    return best >> shift, low - (best & low), end


def align(h: np.ndarray, cut: np.ndarray, items: Items, mask: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """Text, item, score, first word and end of each alignment of at least threshold in a block; the best of each text and item."""
    at, seed = items.hits(h, cut, mask)
    times = items.first[seed + 1] - items.first[seed]
    entry = np.repeat(items.first[seed], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    at, item, place, weight = np.repeat(at, times), items.item[entry], items.place[entry], np.repeat(items.weight[seed], times)
    doc = np.searchsorted(cut, at, "right") - 1
    order = np.lexsort((at, item, doc))
    at, item, place, doc, weight = at[order], item[order], place[order], doc[order], weight[order]
    size = np.diff(items.cut)
    if not len(at):
        return tuple(np.zeros(0, k) for k in (int, int, float, int, int))
    new = np.append(True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (at[1:] - at[:-1] > size[item[1:]]))
    group = np.cumsum(new) - 1
    pairs, one = np.unique((group << 32) + place, return_index=True)  # different seeds of a cluster
    many = np.bincount(pairs >> 32, weight[one], group[-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    ok = np.flatnonzero(many >= items.least[item[first]])
    first, last = first[ok], last[ok]
    what, whose = item[first], doc[first]
    slack = size[what] // 2 + 3
    begin = np.maximum(cut[whose], at[first] - place[first] - slack)
    end = np.minimum(cut[whose + 1], at[last] - place[last] + size[what] + slack)
    score, starts, ends = np.zeros(len(ok)), np.zeros(len(ok), np.int64), np.zeros(len(ok), np.int64)
    todo = np.lexsort((end - begin, size[what]))
    while len(todo):
        cells = np.maximum.accumulate(size[what[todo]]) * np.maximum.accumulate(end[todo] - begin[todo]) * np.arange(1, len(todo) + 1)
        k = max(1, int(np.searchsorted(cells, 2_000_000, "right")))
        part, todo = todo[:k], todo[k:]
        m, w = size[what[part]].max(), (end - begin)[part].max()
        a, b = np.zeros((k, m), U), np.ones((k, w), U)  # 0 and 1: no word
        for r, x in enumerate(part):
            own, seen = items.words[items.cut[what[x]] : items.cut[what[x] + 1]], h[begin[x] : end[x]]
            a[r, : len(own)], b[r, : len(seen)] = own, seen
        s, i, j = smith_waterman(a, b)
        score[part], starts[part], ends[part] = s / (MATCH * size[what[part]]), begin[part] + i - cut[whose[part]], begin[part] + j - cut[whose[part]]
    found = np.flatnonzero(score >= threshold)
    found = found[np.lexsort((starts[found], -score[found], what[found], whose[found]))]
    top = np.append(True, (whose[found][1:] != whose[found][:-1]) | (what[found][1:] != what[found][:-1])) if len(found) else np.zeros(0, bool)
    found = found[top]
    return whose[found], what[found], score[found], starts[found], ends[found]


def item_blocks(items: DataFrame, n: int, block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """The items in blocks of about block_words words, streamed to the driver one block at a time."""
    ids, texts, size = [], [], 0
    for row in items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null").toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1]) // 2 + 1  # as many words at most
        if size >= block_words:
            yield Items.of(ids, texts, n)
            ids, texts, size = [], [], 0
    if ids:
        yield Items.of(ids, texts, n)


def _df(path: str):  # noqa: ANN202
    def df(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = loaded(path)
        mask, total, rows = items.mask(), np.zeros(len(items.seeds), np.int64), 0
        for batch in batches:
            rows += len(batch)
            for b in blocks(batch.column(0), lower=True):
                h, cut, _ = normal(b)
                at, seed = items.hits(h, cut, mask)
                doc = np.searchsorted(cut, at, "right") - 1
                once = np.unique(doc.astype(np.int64) * len(items.seeds) + seed) if len(at) else np.zeros(0, np.int64)
                total += np.bincount(once % max(1, len(items.seeds)), minlength=len(items.seeds))
        seed = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"seed": pa.array(np.append(seed, -1).astype(np.int64)), "df": pa.array(np.append(total[seed], rows))})

    return df


def ready_blocks(docs: DataFrame, items: DataFrame, n: int, share: float, rare_share: float) -> Iterator[str]:
    """Files of blocks of items with their rare seeds, which all rows of docs decide. The driver holds one block at a time."""
    spark = docs.sparkSession
    for block in item_blocks(items, n):
        found = docs.select("text").mapInArrow(_df(stored(spark, block, "items")), "seed long, df long").groupBy("seed").agg(F.sum("df").alias("df")).toArrow()
        df = np.zeros(len(block.seeds) + 1, np.int64)  # at -1 the rows
        df[found["seed"].to_numpy()] = found["df"].to_numpy()
        block.rare(df[:-1], int(df[-1]), share, rare_share)
        yield stored(spark, block, "seeds")


def leaks(docs: DataFrame, items: DataFrame, n: int = 3, share: float = 0.85, rare_share: float = 1e-4, threshold: float = 0.4) -> DataFrame:
    """Passages of items in docs: doc_id, item_id, score, first_word and end_word, the best of each row of docs and item.

    score is the alignment's (match 2, mismatch and gap -1) over that of the whole item with itself; first_word and end_word count the
    text's words without those of punctuation alone. Words are compared without punctuation at their ends and in lower case. A
    passage holds one seed (n words of the item) that at most rare_share of the rows hold, or two of the share of the item's seeds that
    fewest rows hold, no further apart than the item is long.

    An item of fewer than n words is a seed itself, found where its words stand one after another, if at most rare_share of the rows (or 2) hold it.

    Null or empty texts and items match nothing; of equal scores in a text the first passage counts; texts of any length are searched whole, an item's
    alignment takes time in proportion to its length times the passage's, and memory in proportion to its length; a row with a null doc_id is reported with null; items
    of a null item_id are left out; repeated rows of docs or items give repeated results; empty tables an empty result. Other columns
    are ignored.
    """
    start(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for block in ready_blocks(docs, items, n, share, rare_share):
        part = docs.mapInArrow(_leaks(block, threshold), LEAKS)
        out = part if out is None else out.union(part)
    return docs.sparkSession.createDataFrame([], LEAKS) if out is None else out


LEAKS = "doc_id long, item_id long, score double, first_word long, end_word long"


def _leaks(path: str, threshold: float):  # noqa: ANN202
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = loaded(path)
        mask = items.mask()
        for batch in batches:
            for b in blocks(batch.column(1), lower=True):
                h, cut, _ = normal(b)
                doc, item, score, first, end = align(h, cut, items, mask, threshold)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).take(pa.array(doc + b.first)), "item_id": pa.array(items.ids[item]), "score": pa.array(score), "first_word": pa.array(first), "end_word": pa.array(end),
                })

    return found


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 3, share: float = 0.85, rare_share: float = 1e-4, threshold: float = 0.4) -> DataFrame:
    """The rows of docs in which no passage is found, with their columns. For cases, see leaks; a null text stays, and
    ties and repeated rows go or stay together."""
    start(docs)
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    for block in ready_blocks(docs, items, n, share, rare_share):

        def clean(batches: Iterator[pa.RecordBatch], path: str = block) -> Iterator[pa.RecordBatch]:
            block = loaded(path)
            mask = block.mask()
            for batch in batches:
                keep = np.ones(len(batch), bool)
                for b in blocks(text_of(batch.column(0)), lower=True):
                    h, cut, _ = normal(b)
                    keep[align(h, cut, block, mask, threshold)[0] + b.first] = False
                yield batch.filter(pa.array(keep))

        rows = rows.mapInArrow(clean, StructType(rows.schema.fields))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])
