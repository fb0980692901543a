"""Token counts: greedy longest-match word pieces, counted by an automaton in time linear in the bytes.

The automaton is a trie of the vocabulary. Where a byte has no transition from a node, the node's pieces are settled: their number is
popped[node], and matching goes on at failure[node], both worked out beforehand (as in the linear-time MaxMatch of Song et al., 2021).
No piece is built. The distinct words of a block are matched together, a byte of each at a time.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.blocks import Block, blocks
from factloom.llm.shared import start

#: Longer words are matched one by one: a step over all words for each of their bytes would cost more.
LONG_WORD = 128


def vocabulary(path: str) -> list[bytes]:
    """The tokens of a file of ranks: a base64 token and its rank in each line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class Automaton:
    """Counts the pieces of byte strings."""

    def __init__(self, tokens: Iterable[bytes]):
        child: list[dict[int, int]] = [{}]
        final = [False]
        for token in tokens:
            node = 0
            for c in token:
                at = child[node].get(c)
                if at is None:
                    at = child[node][c] = len(child)
                    child.append({})
                    final.append(False)
                node = at
            final[node] = node != 0
        n = len(child)
        failure, popped = np.full(n, -1, np.int32), np.zeros(n, np.int32)
        queue = [0]
        for u in queue:  # breadth first, so that shorter prefixes are done
            for c, v in child[u].items():
                queue.append(v)
                if final[v]:
                    failure[v], popped[v] = 0, 1
                    continue
                z, pops = int(failure[u]), int(popped[u])
                while z >= 0 and c not in child[z]:
                    pops += int(popped[z])
                    z = int(failure[z])
                if z >= 0:
                    failure[v], popped[v] = child[z][c], pops
        self.failure, self.popped = failure, popped
        key = np.array([u << 8 | c for u in range(n) for c in child[u]], np.int64)
        to = np.array([v for u in range(n) for v in child[u].values()], np.int32)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(key)) * 3))))
        self.keys, self.to = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):  # each round, of those that want one free slot the first gets it
            free = self.keys[slot[todo]] < 0
            at, first = np.unique(slot[todo[free]], return_index=True)
            won = todo[free][first]
            self.keys[at], self.to[at] = key[won], to[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, node: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Where byte c leads from node; -1 where nowhere."""
        key = node.astype(np.int64) << 8 | c
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.to[slot], -1)
        todo = np.flatnonzero((found != key) & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.to[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out

    def count(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, before: bytes = b" ") -> np.ndarray:
        """Pieces of each span of buf, preceded by `before`; 1 for a span that the vocabulary can't cover."""
        size = end - start
        out = np.zeros(len(start), np.int64)
        long = np.flatnonzero(size > LONG_WORD)
        for i in long:
            out[i] = self._one(before + buf[start[i] : end[i]].tobytes())
        order = np.flatnonzero(size <= LONG_WORD)
        order = order[np.argsort(-size[order], kind="stable")]
        start, size = start[order], size[order]
        node, pieces, dead = np.zeros(len(order), np.int32), np.zeros(len(order), np.int64), np.zeros(len(order), bool)
        alive = np.searchsorted(-size, -np.arange(1, int(size.max(initial=0)) + 1), "right")  # how many words reach each length
        for t in range(-len(before), len(alive)):
            k = len(order) if t < 0 else int(alive[t])
            c = np.full(k, before[t]) if t < 0 else buf[start[:k] + t]
            to = self.step(node[:k], c.astype(np.int64))
            todo = np.flatnonzero(to < 0)
            while len(todo):
                at = node[todo]
                pieces[todo] += self.popped[at]
                back = self.failure[at]
                dead[todo[back < 0]] = True
                todo, back = todo[back >= 0], back[back >= 0]
                node[todo] = back
                to[todo] = self.step(back, c[todo].astype(np.int64))
                todo = todo[to[todo] < 0]
            node[:k] = np.maximum(to, 0)
        todo = np.flatnonzero(node > 0)
        while len(todo):
            pieces[todo] += self.popped[node[todo]]
            back = self.failure[node[todo]]
            dead[todo[back < 0]] = True
            node[todo] = np.maximum(back, 0)
            todo = todo[back > 0]
        out[order] = np.where(dead, 1, pieces)
        return out

    def _one(self, word: bytes) -> int:
        node, pieces = 0, 0
        failure, popped, keys, to = self.failure, self.popped, self.keys, self.to
        top = len(keys) - 1

        def step(node: int, c: int) -> int:
            key = node << 8 | c
            slot = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
            while (found := keys[slot]) >= 0:
                if found == key:
                    return int(to[slot])
                slot = slot + 1 & top
            return -1

        for c in word:
            while (at := step(node, c)) < 0:
                pieces += int(popped[node])
                node = int(failure[node])
                if node < 0:
                    return 1
            node = at
        while node > 0:
            pieces += int(popped[node])
            node = int(failure[node])
        return 1 if node < 0 else pieces


def count_block(b: Block, automaton: Automaton) -> np.ndarray:
    """Pieces of each text of a block; each distinct word is matched once."""
    _, first, of = np.unique(b.hashes(), return_index=True, return_inverse=True)
    return b.per_doc(automaton.count(b.buf, b.start[first], b.end[first])[of], b.cut)


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_bytes (of the words) and n_pieces.

    Each word (run of characters other than space and \\t to \\r), with a space before it, is cut into the longest tokens of the
    vocabulary from the left; white space between words counts nothing. A word that can't be cut so is one piece. A null or empty
    text has 0 of each; a null doc_id stays null; repeated rows give equal rows; an empty table an empty result. Other columns are
    ignored. One pass without a shuffle; the automaton (some 12 MB for 50,000 tokens) goes to each worker.
    """
    start(docs)
    automaton = Automaton(vocabulary(vocabulary_path))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, size, pieces = (np.zeros(len(batch), np.int64) for _ in range(3))
            for b in blocks(batch.column(1)):
                at = slice(b.first, b.first + b.n)
                words[at], size[at], pieces[at] = np.diff(b.cut), b.per_doc(b.end - b.start, b.cut), count_block(b, automaton)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_words": pa.array(words), "n_bytes": pa.array(size), "n_pieces": pa.array(pieces)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(counts, "doc_id long, n_words long, n_bytes long, n_pieces long")
