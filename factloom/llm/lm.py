"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation, beside an add-one unigram model.

The vocabulary are all words with more than one in hot_share of the training tokens (so at most hot_share words, and as many more as the
corpus grows until then). Words fall into classes: the most frequent ones have one each, the others are clustered by the frequent words
near them, which tells languages and kinds of words apart. Two log-bilinear models make a token's probability,
P(class | classes of the two tokens before) and P(word | class, class of the token before), where every word of the vocabulary has a
vector. Both are normalised exactly: over all classes for each pair of classes before, and over a class's words for each class before, by
products of matrices. Words outside the vocabulary share the class `rare` by their counts, which cover all training documents.

Training takes counts of (class, class, class) and (class, word) over all training documents instead of the texts: whole numbers that
don't depend on how the table is cut, in shards that depend on them alone. So scores don't depend on partitions, and
a hot group of copies is a larger count. Each shard trains on all its cells from one start, and parameters are averaged by tokens, in rounds.

Counts of words: frequent words are broadcast. The others meet their counts in a shuffle of packed arrays, where a word has at most
one in hot_share of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.blocks import Block, U, blocks, mix, trim
from factloom.llm.parts import part_keys, shuffle_partitions, split_by, to_parts
from factloom.llm.shared import scan_bytes, start, written

START, END, RARE, WORDS = 0, 1, 2, 3
#: The token at the end of a text; words' hashes are mixed sums of odd numbers and their lengths, so none is known to be this.
END_HASH = mix(np.array([0x5EED0FE4D], U))[0]
FLUSH = 2_000_000
#: Words whose neighbourhoods tell classes apart, dimensions that are kept of them, and how far a neighbourhood reaches.
ANCHORS, PLANES, REACH = 256, 32, 2
#: Cells of counts in a shard of training.
SHARD = 2_000_000


class Index:
    """Places of hashes in a sorted array, by a table of their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        self.bits = int(max(8, np.ceil(np.log2(max(1, len(keys)))) + 1))
        self.first = np.searchsorted(self.keys, np.arange(1 << self.bits, dtype=U) << U(64 - self.bits)).astype(np.int32)
        self.first = np.append(self.first, np.int32(len(keys)))

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 where it isn't held."""
        slot = (h >> U(64 - self.bits)).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        out = np.full(len(h), -1, np.int32)
        live = np.flatnonzero(at < end)
        at, end, h = at[live], end[live], h[live]
        while len(live):
            hit = self.keys[at] == h
            out[live[hit]] = at[hit]
            at += 1
            go = ~hit & (at < end)
            live, at, end, h = live[go], at[go], end[go], h[go]
        return out


def tokens(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text and an end, and the bounds of each text."""
    out = np.full(len(b.start) + b.n, END_HASH, U)
    cut = b.cut + np.arange(b.n + 1)
    ends = np.zeros(len(out), bool)
    ends[cut[1:] - 1] = True
    out[~ends] = b.hashes()
    return out, cut


# Counts of 64-bit keys: added up in each task, and once more after a shuffle of packed arrays.

COUNTED = "kind int, part int, words binary, counts binary"
SUMMED = "kind int, part int, words binary, counts binary, n_words long, n_tokens long"


def _counted(find: Callable, parts: dict[int, np.ndarray]):  # noqa: ANN202
    """find: for a block of texts (kind, keys, a number that tells each key's part) of what it holds; parts: part keys of each kind."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows = []
            for kind, found in sorted(held.items()):
                keys, c = np.unique(np.concatenate([k for k, _ in found]), return_counts=True)
                own = parts[kind]
                spread = (found[0][1](keys) % U(len(own))).astype(np.int64)
                rows += [(kind, own[p], k.tobytes(), n.astype(np.uint32).tobytes()) for p, (k, n) in enumerate(split_by(spread, len(own), keys, c)) if len(k)]
            held.clear()
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["kind", "part", "words", "counts"])

        for batch in batches:
            for b in blocks(batch.column(0), lower=True):
                for kind, keys, spread in find(b):
                    if len(keys):
                        held.setdefault(kind, []).append((keys, spread))
                        size += len(keys)
                if size >= FLUSH:
                    yield flush()
                    size = 0
        if held:
            yield flush()
        trim()

    return counted


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    k, c = k[order], c[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[first], np.add.reduceat(c, first)


def _added(group: int):  # noqa: ANN202
    """group: keys that are equal when divided by it stay in one row."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of a part's counts; runs are merged as they come, so that memory goes with the distinct keys."""
        held: dict[tuple[int, int], tuple[list, list, int]] = {}
        for batch in batches:
            for kind, part, words, counts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                keys, sums, size = held.get((kind, part), ([], [], 0))
                keys.append(np.frombuffer(words, U))
                sums.append(np.frombuffer(counts, np.uint32).astype(np.int64))
                size += len(keys[-1])
                if size > 2 * len(keys[0]) + FLUSH:
                    k, c = _merged(keys, sums)
                    keys, sums, size = [k], [c], len(k)
                held[kind, part] = (keys, sums, size)
        for (kind, part), (keys, sums, _) in sorted(held.items()):
            h, c = _merged(keys, sums)
            at = 0
            while at < len(h):
                end = min(len(h), at + 500_000)
                end = int(np.searchsorted(h, (h[end - 1] // U(group) + U(1)) * U(group))) if group > 1 else end
                k, n = h[at:end], c[at:end]
                at = end
                yield pa.RecordBatch.from_pydict({
                    "kind": pa.array([kind], pa.int32()), "part": pa.array([part], pa.int32()), "words": pa.array([k.tobytes()], pa.binary()),
                    "counts": pa.array([n.tobytes()], pa.binary()), "n_words": pa.array([len(k)]), "n_tokens": pa.array([n.sum()]),
                })
        trim()

    return added


def count(docs: DataFrame, find: Callable, parts: dict[int, np.ndarray], name: str, group: int = 1) -> DataFrame:
    """Counts over all training documents, written: rows of SUMMED."""
    n = max(len(p) for p in parts.values())
    sent = docs.where("not held_out").select("text").mapInArrow(_counted(find, parts), COUNTED)
    return written(to_parts(sent, n).mapInArrow(_added(group), SUMMED), name)


def data_parts(docs: DataFrame) -> int:
    """Partitions for what the texts hold: by the bytes to read, and bounded, as a part merges what it gets as it comes."""
    return int(min(4096, max(12, scan_bytes(docs) // (16 << 20))))


@dataclass
class Vocabulary:
    """Counts of frequent words, all tokens and distinct words of the training documents, and the classes of the model."""

    hot: Index
    counts: np.ndarray
    n: int
    v: int
    classes: int = WORDS
    of_hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int16))
    rare_n: int = 0
    rare_v: int = 0

    def __post_init__(self) -> None:
        self.set_classes(np.full(len(self.counts), RARE, np.int16), WORDS)

    def by_count(self) -> np.ndarray:
        """Places of words, without the end, by falling count."""
        order = np.lexsort((self.hot.keys, -self.counts))
        return order[self.hot.keys[order] != END_HASH]

    def set_classes(self, of_hot: np.ndarray, classes: int) -> None:
        self.of_hot, self.classes = of_hot, classes
        end = self.hot.find(np.array([END_HASH], U))[0]
        if end >= 0:
            self.of_hot[end] = END
        known = self.of_hot != RARE
        self.rare_n, self.rare_v = self.n - int(self.counts[known].sum()), self.v - int(known.sum())

    def unigram(self) -> np.ndarray:
        """Probabilities of the classes, each at least a little."""
        out = np.zeros(self.classes)
        np.add.at(out, self.of_hot, self.counts)
        out[RARE] = self.rare_n
        out[START] = 0
        out[END:] += 1
        return out / out.sum()

    def classed(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the frequent words (-1: none) and class of each token."""
        at = self.hot.find(h)
        out = np.full(len(h), RARE, np.int16)
        out[at >= 0] = self.of_hot[at[at >= 0]]
        out[h == END_HASH] = END
        return at, out


def count_words(docs: DataFrame, hot_share: int, rare: int) -> Vocabulary:
    """Counts over all training documents. Words that come up to `rare` times stand for those that training hasn't seen."""
    table = count(docs, lambda b: [(0, tokens(b)[0], _as_is)], {0: part_keys(data_parts(docs))}, "word-counts")
    n, v = (int(x or 0) for x in table.agg(F.sum("n_tokens"), F.sum("n_words")).first())
    least = max(n / hot_share, rare)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                c = np.frombuffer(counts, np.int64)
                yield pa.RecordBatch.from_pydict({"h": pa.array(np.frombuffer(words, np.int64)[c > least]), "c": pa.array(c[c > least])})

    hot = table.select("words", "counts").mapInArrow(frequent, "h long, c long").toArrow()
    h = hot["h"].to_numpy().astype(np.int64).view(U)
    order = np.argsort(h)
    return Vocabulary(Index(h), hot["c"].to_numpy().astype(np.int64)[order], n, v)


def _as_is(keys: np.ndarray) -> np.ndarray:
    return keys


# Classes of words.


def neighbours(at: np.ndarray, anchor: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """word * ANCHORS + anchor for each frequent word and anchor near it in its text. anchor: for each frequent word its number or -1."""
    doc = np.repeat(np.arange(len(cut) - 1, dtype=np.int32), np.diff(cut))
    number = np.where(at >= 0, anchor[at], -1) if len(anchor) else np.full(len(at), -1)
    out = []
    for k in range(1, REACH + 1):
        for word, near in ((slice(k, None), slice(None, -k)), (slice(None, -k), slice(k, None))):
            ok = (at[word] >= 0) & (number[near] >= 0) & (doc[word] == doc[near])
            out.append(at[word][ok].astype(U) * U(ANCHORS) + number[near][ok].astype(U))
    return np.concatenate(out)


def _planes(rows: np.ndarray) -> np.ndarray:
    """The principal directions of the anchors' own neighbourhoods, counts by row."""
    x = np.sqrt(rows / np.maximum(rows.sum(1, keepdims=True), 1))
    x -= x.mean(0)
    _, _, right = np.linalg.svd(x, full_matrices=False)
    sign = np.sign(right[np.arange(len(right)), np.abs(right).argmax(1)])
    return (right * sign[:, None])[:PLANES].T


def word_vectors(docs: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """A vector for each frequent word of the frequent words near it in all training documents."""
    order = vocabulary.by_count()
    anchor = np.full(len(vocabulary.counts), -1, np.int32)
    anchor[order[:ANCHORS]] = np.arange(min(ANCHORS, len(order)))
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.hot, anchor))

    def find(b: Block) -> Iterator[tuple]:
        hot, number = shared.value
        h, cut = tokens(b)
        yield 0, neighbours(hot.find(h), number, cut), lambda keys: mix(keys // U(ANCHORS))

    table = count(docs, find, {0: part_keys(data_parts(docs))}, "neighbours", ANCHORS).select("words", "counts")

    def dense(words: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
        k, c = np.frombuffer(words, U), np.frombuffer(counts, np.int64)
        word, row = np.unique((k // U(ANCHORS)).astype(np.int64), return_inverse=True)
        out = np.zeros((len(word), ANCHORS), np.float32)
        np.add.at(out, (row, (k % U(ANCHORS)).astype(np.int64)), c)
        return word, out

    def of_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value[1]
        for batch in batches:
            for words, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                word, rows = dense(words, counts)
                yield from _vectors(word[number[word] >= 0], rows[number[word] >= 0])

    own = _collected(table.mapInArrow(of_anchors, "word long, x binary"), len(vocabulary.counts), ANCHORS, order[:ANCHORS])
    planes = _planes(own.astype(np.float64)).astype(np.float32) if len(own) else np.zeros((ANCHORS, PLANES), np.float32)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                word, rows = dense(words, counts)
                yield from _vectors(word, rows @ planes, rows.sum(1))

    return _collected(table.mapInArrow(projected, "word long, x binary"), len(vocabulary.counts), planes.shape[1] + 1, None)


def _vectors(word: np.ndarray, rows: np.ndarray, total: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    rows = np.ascontiguousarray(rows if total is None else np.column_stack([rows, total]), np.float32)
    if len(word):
        yield pa.RecordBatch.from_pydict({"word": pa.array(word), "x": pa.array([r.tobytes() for r in rows], pa.binary())})


def _collected(rows: DataFrame, n: int, width: int, which: np.ndarray | None) -> np.ndarray:
    """Vectors by word, each sent once; at most hot_share words."""
    out = np.zeros((n, width), np.float32)
    got = rows.toArrow()
    if len(got):
        out[got["word"].to_numpy()] = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(len(got), width)
    return out if which is None else out[which]


def cluster(x: np.ndarray, first: np.ndarray, rounds: int = 12) -> np.ndarray:
    """The cluster of each row by k-means from the rows `first`; ties go to the first cluster."""
    centre = x[first].copy()
    out = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        half = (centre * centre).sum(1) / 2
        out = np.concatenate([(x[i : i + 20_000] @ centre.T - half).argmax(1) for i in range(0, len(x), 20_000)]) if len(x) else out
        sums = np.stack([np.bincount(out, x[:, k], len(centre)) for k in range(x.shape[1])], 1)
        n = np.bincount(out, minlength=len(centre))
        centre = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centre).astype(np.float32)
    return out


def classes_of(vocabulary: Vocabulary, vectors: np.ndarray, single: int, clusters: int) -> tuple[np.ndarray, int]:
    """Class of each frequent word, and the number of classes: `single` words have their own, the others share `clusters`."""
    order = vocabulary.by_count()
    out = np.full(len(vocabulary.counts), RARE, np.int16)
    out[order[:single]] = WORDS + np.arange(len(order[:single]))
    rest = order[single:]
    k = min(clusters, len(rest))
    if k:
        x = vectors[rest, :-1] / np.maximum(vectors[rest, -1:], 1)
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        found = cluster(x.astype(np.float32), np.arange(k))
        _, found = np.unique(found, return_inverse=True)
        out[rest] = WORDS + min(single, len(order)) + found
        k = int(found.max()) + 1
    return out, WORDS + min(single, len(order)) + k


# The model.


def contexts(c: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two tokens before each, START before the text."""
    one, two = (np.full(len(c), START, c.dtype) for _ in range(2))
    one[1:], two[2:] = c[:-1], c[:-2]
    first = cut[:-1]
    one[first] = START
    two[first] = START
    second = first + 1
    second = second[second < cut[1:]]
    two[second] = START
    return one, two


def rows_of(cells: np.ndarray, counts: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Places of cells in an order for training, and weights: a cell of a large count comes several times, all of it at most three times as
    often as there are cells, so that no batch is one cell."""
    unit = max(1.0, counts.sum() / max(1, 2 * len(cells)))
    times = np.ceil(counts / unit).astype(np.int64)
    at = rng.permutation(np.repeat(np.arange(len(cells)), times))
    return at, (counts / times)[at].astype(np.float32)


def batch_size(rows: int) -> int:
    """Rows of a step: few enough that a small table takes many steps."""
    return min(4096, max(128, rows // 2000))


class LogBilinear:
    """score(w | c1, c2) = (R[c1] C1 + R[c2] C2) . Q[w] + b[w], over classes."""

    def __init__(self, unigram: np.ndarray, size: int = 16, noise: int = 64, rate: float = 0.15, seed: int = 11):
        self.rng, self.noise, self.rate = np.random.default_rng(seed), noise, rate
        self.p = np.maximum(unigram, 1e-12)
        k = len(unigram)
        draw = lambda *s: self.rng.normal(0, 0.1, s).astype(np.float32)
        self.w = {"R": draw(k, size), "Q": draw(k, size), "b": np.log(self.p).astype(np.float32), "C1": np.eye(size, dtype=np.float32), "C2": 0.5 * np.eye(size, dtype=np.float32)}
        self.seen = {c: np.full(v.shape, 1e-6, np.float32) for c, v in self.w.items()}
        self.log_noise = (np.log(self.p) + np.log(noise)).astype(np.float32)

    def step(self, target: np.ndarray, one: np.ndarray, two: np.ndarray, weight: np.ndarray) -> None:
        """A batch: each cell against its class and the batch's noise classes, drawn from the unigram distribution."""
        w = self.w
        noise = self.rng.choice(len(self.p), self.noise, p=self.p / self.p.sum())
        r1, r2 = w["R"][one], w["R"][two]
        hat = r1 @ w["C1"] + r2 @ w["C2"]
        q, qn = w["Q"][target], w["Q"][noise]
        share = weight / weight.sum()
        right = share * (1 - _sigmoid(np.einsum("ij,ij->i", hat, q) + w["b"][target] - self.log_noise[target]))
        wrong = -share[:, None] * _sigmoid(hat @ qn.T + w["b"][noise] - self.log_noise[noise])
        back = right[:, None] * q + wrong @ qn
        g = {"C1": r1.T @ back, "C2": r2.T @ back, "Q": _sums(target, right[:, None] * hat, len(self.p)), "b": np.bincount(target, right, len(self.p)).astype(np.float32)}
        np.add.at(g["Q"], noise, wrong.T @ hat)
        np.add.at(g["b"], noise, wrong.sum(0))
        g["R"] = _sums(one, back @ w["C1"].T, len(self.p)) + _sums(two, back @ w["C2"].T, len(self.p))
        for c, d in g.items():
            self.seen[c] += d * d
            w[c] += self.rate * d / np.sqrt(self.seen[c])

    def fit(self, cells: np.ndarray, counts: np.ndarray) -> LogBilinear:
        """A pass over cells, (class two before * K + class before) * K + class, and their counts."""
        k = U(len(self.p))
        target, one, two = ((cells // d % k).astype(np.int64) for d in (U(1), k, k * k))
        at, weight = rows_of(cells, counts, self.rng)
        batch = batch_size(len(at))
        for a in range(0, len(at), batch):
            i = at[a : a + batch]
            self.step(target[i], one[i], two[i], weight[a : a + batch])
        return self

    def packed(self) -> bytes:
        return b"".join(x.astype(np.float64).tobytes() for side in (self.w, self.seen) for x in side.values())

    def load(self, values: np.ndarray) -> None:
        at = 0
        for side in (self.w, self.seen):
            for c, v in side.items():
                side[c] = values[at : at + v.size].reshape(v.shape).astype(np.float32)
                at += v.size

    def ready(self) -> None:
        """The normaliser of every context: rows of products of all first contexts with all second ones."""
        self.one, self.two = self.w["R"] @ self.w["C1"], self.w["R"] @ self.w["C2"]
        k = len(self.p)
        self.log_z = np.empty((k, k), np.float32)
        q, b = self.w["Q"][END:].T, self.w["b"][END:]
        second = self.two @ q
        for c in range(k):
            s = second + (self.one[c] @ q + b)
            top = s.max(1, keepdims=True)
            self.log_z[c] = np.log(np.exp(s - top).sum(1)) + top[:, 0]

    def log_probability(self, target: np.ndarray, one: np.ndarray, two: np.ndarray, chunk: int = 1 << 16) -> np.ndarray:
        """Natural log of the normalised probability of each class after its context."""
        out = np.empty(len(target))
        for at in range(0, len(target), chunk):
            t, i, j = target[at : at + chunk], one[at : at + chunk], two[at : at + chunk]
            out[at : at + chunk] = np.einsum("ij,ij->i", self.one[i] + self.two[j], self.w["Q"][t]) + self.w["b"][t] - self.log_z[i, j]
        return out


class WithinClass:
    """score(w | class, c1) = context[c1] . Q[w] + log(share of w in its class), over the words of a class; context comes from the class model."""

    def __init__(self, vocabulary: Vocabulary, context: np.ndarray):
        self.of = vocabulary.of_hot
        total = np.bincount(self.of, vocabulary.counts, vocabulary.classes)
        self.share = np.log(np.maximum(vocabulary.counts, 1) / np.maximum(total[self.of], 1)).astype(np.float32)
        self.context = context.astype(np.float32)
        self.q = np.zeros((len(self.of), context.shape[1]), np.float32)

    def fit(self, word: np.ndarray, one: np.ndarray, counts: np.ndarray, seed: int = 13, noise: int = 16, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
        """Words of one class and their vectors, after a pass over its cells (word, class before, count); noise are words of the class."""
        words = np.flatnonzero(self.of == self.of[word[0]])
        rng = np.random.default_rng([seed, int(self.of[word[0]])])
        own = np.searchsorted(words, word)
        p = np.exp(self.share[words].astype(np.float64))
        p /= p.sum()
        q, seen = np.zeros((len(words), self.context.shape[1]), np.float32), np.full((len(words), self.context.shape[1]), 1e-6, np.float32)
        log_noise = np.float32(np.log(noise))  # scores start from the noise's own log probabilities, which cancel
        at, weight = rows_of(own, counts, rng)
        batch = batch_size(len(at))
        for a in range(0, len(at), batch):
            i, w = at[a : a + batch], weight[a : a + batch]
            t, u, w = own[i], self.context[one[i]], w / w.sum()
            n = rng.choice(len(words), noise, p=p)
            right = w * (1 - _sigmoid(np.einsum("ij,ij->i", u, q[t]) - log_noise))
            wrong = -w[:, None] * _sigmoid(u @ q[n].T - log_noise)
            g = _sums(t, right[:, None] * u, len(words))
            np.add.at(g, n, wrong.T @ u)
            seen += g * g
            q += rate * g / np.sqrt(seen)
        return words, q

    def ready(self, classes: int) -> None:
        """The normaliser of each class of words after each class: a product of matrices for each class of words."""
        self.log_z = np.zeros((classes, classes), np.float32)
        order = np.argsort(self.of, kind="stable")
        bounds = np.searchsorted(self.of[order], np.arange(classes + 1))
        for k in range(WORDS, classes):
            own = order[bounds[k] : bounds[k + 1]]
            if len(own) > 1:
                for c in range(0, classes, 64):
                    s = self.context[c : c + 64] @ self.q[own].T + self.share[own]
                    top = s.max(1, keepdims=True)
                    self.log_z[c : c + 64, k] = np.log(np.exp(s - top).sum(1)) + top[:, 0]

    def log_probability(self, at: np.ndarray, one: np.ndarray, chunk: int = 1 << 16) -> np.ndarray:
        """Natural log of the probability of each word (its place) in its class, after a class."""
        out = np.empty(len(at))
        for a in range(0, len(at), chunk):
            w, i = at[a : a + chunk], one[a : a + chunk]
            out[a : a + chunk] = np.einsum("ij,ij->i", self.context[i], self.q[w]) + self.share[w] - self.log_z[i, self.of[w]]
        return out


@dataclass
class Model:
    """Both parts, for a vocabulary with classes."""

    vocabulary: Vocabulary
    classes: LogBilinear
    within: WithinClass

    def log_probability(self, at: np.ndarray, c: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Natural log of each token's probability; for words of the class rare it is the class's."""
        one, two = contexts(c, cut)
        out = self.classes.log_probability(c, one, two)
        word = np.flatnonzero(c >= WORDS)
        out[word] += self.within.log_probability(at[word], one[word])
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sums(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(at, rows[:, k], n) for k in range(rows.shape[1])], 1).astype(np.float32)


def cells_of(vocabulary: Vocabulary, shared: np.ndarray, h: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of (class, class, class) for each token, and class before * words + word for words that share a class."""
    at, c = vocabulary.classed(h)
    one, two = contexts(c, cut)
    k = U(vocabulary.classes)
    word = np.flatnonzero(at >= 0)
    word = word[shared[at[word]]]
    return (two.astype(U) * k + one.astype(U)) * k + c.astype(U), one[word].astype(U) * U(len(shared)) + at[word].astype(U)


def _gathered(batches: Iterator[pa.RecordBatch]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Keys, in order, and counts of each part."""
    held: dict[int, tuple[list, list]] = {}
    for batch in batches:
        for part, words, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "words", "counts")), strict=True):
            keys, sums = held.setdefault(part, ([], []))
            keys.append(np.frombuffer(words, U))
            sums.append(np.frombuffer(counts, np.int64))
    return {part: _merged(*held[part]) for part in sorted(held)}


def train(docs: DataFrame, vocabulary: Vocabulary, size: int, rounds: int) -> Model:
    """The model after `rounds` passes over the cells of all training documents."""
    spark = docs.sparkSession
    model = LogBilinear(vocabulary.unigram(), size)
    several = np.bincount(vocabulary.of_hot, minlength=vocabulary.classes) > 1
    several[:WORDS] = False
    member = several[vocabulary.of_hot]
    sent = spark.sparkContext.broadcast((vocabulary, member))

    def find(b: Block) -> Iterator[tuple]:
        v, m = sent.value
        h, cut = tokens(b)
        cells, words = cells_of(v, m, h, cut)
        yield 0, cells, mix
        yield 1, words, lambda keys: mix(v.of_hot[(keys % U(len(m))).astype(np.int64)].astype(U))

    parts = part_keys(data_parts(docs))
    table = count(docs, find, {0: parts, 1: parts}, "cells")
    sizes = {r.kind: r.n for r in table.groupBy("kind").agg(F.sum("n_words").alias("n")).collect()}
    if not sizes:
        model.ready()
        within = WithinClass(vocabulary, model.one)
        within.ready(vocabulary.classes)
        return Model(vocabulary, model, within)

    shards = part_keys(max(1, -(-sizes[0] // SHARD)))

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                k, c = np.frombuffer(words, U), np.frombuffer(counts, np.int64)
                spread = (mix(k + U(1)) % U(len(shards))).astype(np.int64)
                rows = [(0, shards[p], x.tobytes(), y.tobytes()) for p, (x, y) in enumerate(split_by(spread, len(shards), k, c)) if len(x)]
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["kind", "part", "words", "counts"])

    cells = table.where("kind = 0").select("words", "counts").mapInArrow(sharded, COUNTED)
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(model)

        def fitted(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for part, (keys, counts) in _gathered(batches).items():
                own = _copy(now.value, part)
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n": pa.array([float(counts.sum())]), "model": pa.array([own.fit(keys, counts).packed()], pa.binary())})
            trim()

        got = sorted(to_parts(cells, len(shards)).mapInArrow(fitted, "part int, n double, model binary").collect())
        model.load(sum(r.n * np.frombuffer(r.model) for r in got) / sum(r.n for r in got))
    model.ready()

    within = WithinClass(vocabulary, model.one)
    sent_within = spark.sparkContext.broadcast(within)

    def worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent_within.value
        n = U(len(w.of))
        for keys, counts in _gathered(batches).values():
            one, word = (keys // n).astype(np.int64), (keys % n).astype(np.int64)
            order = np.lexsort((one, word, w.of[word]))
            one, word, counts = one[order], word[order], counts[order]
            for i in np.split(np.arange(len(word)), np.flatnonzero(np.diff(w.of[word])) + 1):
                if len(i):
                    which, q = w.fit(word[i], one[i], counts[i])
                    yield from _vectors(which, q)
        trim()

    if sizes.get(1):
        # No word is in two classes and no class in two parts, so a vector comes once.
        within.q = _collected(to_parts(table.where("kind = 1").select("kind", "part", "words", "counts"), len(parts)).mapInArrow(worded, "word long, x binary"), len(member), size, None)
    within.ready(vocabulary.classes)
    return Model(vocabulary, model, within)


def _copy(model: LogBilinear, seed: int) -> LogBilinear:
    out = LogBilinear(model.p, model.w["R"].shape[1], model.noise, model.rate, seed)
    out.w, out.seen = ({c: v.copy() for c, v in side.items()} for side in (model.w, model.seen))
    return out


SCORED = "part int, words binary, places binary, base long, row long, doc_id long, held_out boolean, n_tokens long, n_known long, counted double, model double, rare double, n_rare long"


def _scored(sent, parts: np.ndarray):  # noqa: ANN001, ANN202
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        vocabulary = model.vocabulary
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        done, words, places, size = 0, [], [], 0
        log = np.log10(vocabulary.counts + 1.0)

        def flush() -> pa.RecordBatch:
            h, at = np.concatenate(words), np.concatenate(places)
            words.clear()
            places.clear()
            rows = [(parts[p], k.tobytes(), x.tobytes(), base) for p, (k, x) in enumerate(split_by((mix(h) % U(len(parts))).astype(np.int64), len(parts), h, at)) if len(k)]
            return _rows(zip(*rows, strict=True), ("part", "words", "places", "base"))

        for batch in batches:
            ids, held = batch.column(0), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for b in blocks(batch.column(1), lower=True):
                h, cut = tokens(b)
                at, c = vocabulary.classed(h)
                hot, rare = at >= 0, c == RARE
                value = np.where(hot, log[at] if len(log) else 0.0, 0.0)
                lp = model.log_probability(at, c, cut) / np.log(10)
                row = done + np.arange(b.n)
                unseen = np.flatnonzero(~hot)
                doc = np.searchsorted(cut, unseen, "right") - 1
                own = held[b.first : b.first + b.n]
                words.append(h[unseen])
                places.append(((row[doc] << 1) | ~own[doc]).astype(np.uint32))
                size += len(unseen)
                done += b.n
                yield _rows([
                    parts[row % len(parts)], base + row, ids.slice(b.first, b.n), own, np.diff(cut), b.per_doc(hot, cut),
                    _float_sums(value, cut), _float_sums(lp, cut), _float_sums(np.where(rare, value, 0), cut), b.per_doc(rare, cut),
                ], ("part", "row", "doc_id", "held_out", "n_tokens", "n_known", "counted", "model", "rare", "n_rare"))
            if size >= FLUSH:
                yield flush()
                size = 0
        if size:
            yield flush()
        trim()

    return scored


def _float_sums(x: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, cut[:-1]) if len(x) else np.zeros(len(cut) - 1)  # every text has an end, so none is empty


_KINDS = {"part": pa.int32(), "words": pa.binary(), "places": pa.binary(), "held_out": pa.bool_(), "counted": pa.float64(), "model": pa.float64(), "rare": pa.float64()}
_NAMES = [x.split()[0] for x in SCORED.split(", ")]


def _rows(columns: object, names: tuple[str, ...]) -> pa.RecordBatch:
    got = {c: pa.array(v, _KINDS.get(c, pa.int64())) if not isinstance(v, pa.Array) else v for c, v in zip(names, columns, strict=True)}
    n = len(next(iter(got.values())))
    return pa.RecordBatch.from_arrays([got[c] if c in got else pa.nulls(n, _KINDS.get(c, pa.int64())) for c in _NAMES], _NAMES)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts pass; packed words meet their counts, and each text's sums over them follow as further rows."""
    words, rows, train = [], [], []
    for batch in batches:
        packed = batch.column("words").is_valid()
        yield batch.filter(pa.compute.invert(packed))
        for r in batch.filter(packed).select(["words", "places", "base"]).to_pylist():
            at = np.frombuffer(r["places"], np.uint32)
            words.append(np.frombuffer(r["words"], U))
            rows.append(r["base"] + (at >> 1).astype(np.int64))
            train.append((at & 1).astype(np.int8))
    if words:
        h, row, t = np.concatenate(words), np.concatenate(rows), np.concatenate(train)
        words, rows, train = [], [], []
        order = np.argsort(h)
        h, row, t = h[order], row[order], t[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        count = np.add.reduceat(t.astype(np.int64), first)
        count = np.repeat(count, np.diff(np.append(first, len(h))))
        del h, t
        order = np.argsort(row, kind="stable")
        row, count = row[order], count[order]
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        value, known = np.add.reduceat(np.log10(count + 1.0), first), np.add.reduceat((count > 0).astype(np.int64), first)
        for at in range(0, len(first), 200_000):
            s = slice(at, at + 200_000)
            yield _rows([row[first[s]], known[s], value[s], value[s]], ("row", "n_known", "counted", "rare"))
    trim()


def scores(docs: DataFrame, single: int = 253, clusters: int = 256, size: int = 16, rounds: int = 2, hot_share: int = 1_000_000, rare: int = 3, folds: int = 7, held: int = 2) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, model_score.

    Held out are rows with crc32(doc_id as text) mod folds = held; the others train. A null doc_id is the empty text there. Tokens are words,
    lower-cased in A-Z, and one end. base_score: the sum of log10((c + 1) / (n + v + 1)), with c the
    token's count, n all and v the distinct training tokens; score: log10 probability of the text under the model, words outside the
    vocabulary by (c + 1) / (n + v + 1) of the class rare; model_score: the part of it without those shares. A null or empty text is its end.
    Repeated rows train and are scored each. With no training documents counts are 0 and the model is its start. Of words with equal counts those
    of the smaller hash come first, and words at the bound of the vocabulary are all outside it. A text of any length is
    taken whole, as a block by itself. An empty table gives an empty result. Other columns are ignored.

    hot_share, rare: the vocabulary are words with more than one in so many tokens and that come more than `rare` times; single of them have classes of their own, the others are put into
    clusters. rounds: passes over the training cells.
    """
    spark = start(docs)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (F.pmod(F.crc32(name), F.lit(folds)) == held).alias("held_out"))
    vocabulary = count_words(docs, hot_share, rare)
    vocabulary.set_classes(*classes_of(vocabulary, word_vectors(docs, vocabulary), single, clusters))
    model = train(docs, vocabulary, size, rounds)
    # Tokens outside the vocabulary meet their counts: of the training documents as many as the counts say, of all in proportion.
    outside = (vocabulary.n - int(vocabulary.counts.sum())) * folds / max(1, folds - 1)
    parts = part_keys(shuffle_partitions(spark, outside + 1e6, 2e6))
    sent = spark.sparkContext.broadcast(model)
    found = to_parts(docs.mapInArrow(_scored(sent, parts), SCORED), len(parts)).mapInArrow(_met, SCORED)
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "counted", "model", "rare", "n_rare")]
    by = found.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), *sums)
    base = F.col("counted") - F.col("n_tokens") * F.lit(float(np.log10(vocabulary.n + vocabulary.v + 1)))
    score = F.col("model") + F.col("rare") - F.col("n_rare") * F.lit(float(np.log10(vocabulary.rare_n + vocabulary.rare_v + 1)))
    return by.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(vocabulary.n).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"), F.col("model").alias("model_score"))
