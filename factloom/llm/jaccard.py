"""N-gram Jaccard join: a blocked sparse matrix product of documents by n-grams.

1. Equal sets of n-grams form a class; only classes are compared, copies are counted. Classes that look like near copies form nodes of about
   BLOCK classes, by the two smallest hashes of their first members; any other class is a node by itself. A node only says which classes are
   compared together, so a family of k near copies takes about (k / BLOCK)^2 / 2 pairs of nodes and not k^2 / 2 rows.
2. N-grams are ordered from rare to common by bounded tables of counts over all documents (any fixed order gives right results;
   a good one makes them cheap). Sets of sizes a, b that link share at least o = ceil(3 (a + b) / 8) members (for a threshold of
   60 %), hence at least min(p_a - a + o, p_b - b + o) among their first p members. Each class sends its first
   p = n - ceil(0.6 n) + 1 members to the column block of the product that holds them; a block multiplies its part of the matrix
   of nodes with its transpose by runs of equal n-grams, skips pairs whose sizes rule a link out, and adds up overlaps before they leave it.
   What two nodes share bounds what any of their classes share. A block keeps counts too small to matter to itself (see dropped), and pairs
   of nodes whose other counts stay below what the bound leaves (see least_kept) are discarded. So are pairs of single classes of which
   sketches, a bit for some members each, show that too many members differ.
3. What is left, and each node with itself, is multiplied out exactly, in blocks of a few times BLOCK classes with their whole sets. A block
   gives each class its number of links and one edge to its component there, in place of all links.
No pair is dropped for any other reason: no cap on partners, candidates or the length of a run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from factloom.llm.blocks import Block, U, blocks, grams, mix, text_of, trim
from factloom.llm.parts import part_keys, shuffle_partitions, split_by, to_parts
from factloom.llm.shared import salted_join, start, written

#: Bounds of the tables that order n-grams, which are broadcast: 2 ** 18 words and 2 ** 19 n-grams, 12 bytes each.
TOP_WORDS, TOP_GRAMS = 1 << 18, 1 << 19
#: Words counted at once, and the counts from which such a batch reports a word or n-gram.
COUNT_WORDS, LEAST = 2_000_000, 3
BLOCK = 128
#: The level from which a member is one of many texts, here 16 (see Order.sets), and the ratio of sizes within a node.
FREQUENT, NODE_SIZES = 80, 1.25
#: Edges from which components are found by Spark instead of on the driver.
DRIVER_EDGES = 4_000_000
SLOTS = 1 << 22
#: Rows (class, room) up to which workers are told where a set goes; beyond, a join says it.
ROOM_ROWS = 1_000_000


class Counts:
    """Counts of some hashes, in two tables by their leading bits: what meets a larger count in the first goes to the second."""

    def __init__(self, h: np.ndarray, count: np.ndarray):
        order = np.lexsort((h, count))
        self.h, self.count = h[order], count[order].astype(np.float32)
        self._tables: list[tuple[int, np.ndarray, np.ndarray]] = []

    def __getstate__(self) -> dict:
        return {"h": self.h, "count": self.count, "_tables": []}  # built where they are used

    def _build(self) -> None:
        h, count = self.h, self.count
        for extra in (3, 1):
            bits = max(8, int(np.ceil(np.log2(max(1, len(self.h))))) + extra)
            tag, value = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.float32)
            slot = (h >> U(64 - bits)).astype(np.int64)
            tag[slot], value[slot] = h.astype(np.uint32), count  # the last, largest one stays
            self._tables.append((bits, tag, value))
            lost = tag[slot] != h.astype(np.uint32)
            h, count = mix(h[lost]), count[lost]

    def of(self, h: np.ndarray, missing: float) -> np.ndarray:
        if not self._tables:
            self._build()
        out = np.full(len(h), missing, np.float32)
        todo = None
        for bits, tag, value in self._tables:
            slot = (h >> U(64 - bits)).astype(np.int64)
            v = np.where(tag[slot] == h.astype(np.uint32), value[slot], np.float32(0))
            at = np.flatnonzero(v)
            if todo is None:
                out[at] = v[at]
                todo = np.flatnonzero(v == 0)
                h = mix(h[todo])
            else:
                out[todo[at]] = v[at]
        return out


def gram_hashes(b: Block, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words, and of the n-grams of each text with their bounds; a text of fewer words is one n-gram."""
    h = b.hashes()
    g, valid = grams(h, b.cut, n)
    count = np.diff(b.cut)
    short = np.flatnonzero((count > 0) & (count < n))
    for i in short:  # the whole sequence as one, apart from any n-gram
        at, total = b.cut[i], U(count[i])
        for k in range(count[i]):
            total = mix(np.array([total * U(0x9FB21C651E98DF25) ^ h[at + k]], U))[0]
        g[at], valid[at] = total, True
    return h, g, valid


def _counts(n: int):  # noqa: ANN202
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, size = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, parts in ((0, words), (1, pairs)):
                if parts:
                    v, c = np.unique(np.concatenate(parts), return_counts=True)
                    if kind == 0:
                        yield pa.RecordBatch.from_pydict({"kind": pa.array([2], pa.int32()), "h": pa.array([0], pa.int64()), "c": pa.array([c.sum()], pa.int64())})
                    v, c = v[c >= LEAST], c[c >= LEAST]
                    yield pa.RecordBatch.from_pydict({"kind": pa.array(np.full(len(v), kind, np.int32)), "h": pa.array(v.view(np.int64)), "c": pa.array(c.astype(np.int64))})
            words.clear()
            pairs.clear()

        for batch in batches:
            for b in blocks(batch.column(0), lower=True):
                h = b.hashes()
                g, valid = grams(h, b.cut, n)
                words.append(h)
                pairs.append(g[valid])
                size += len(h)
                if size >= COUNT_WORDS:
                    yield from flush()
                    size = 0
        yield from flush()

    return count


class Order:
    """The order of n-grams: by about how many texts hold them, then by hash. A member's key sorts by that order."""

    def __init__(self, docs: DataFrame, n: int):
        self.n = n
        found = docs.select("text").mapInArrow(_counts(n), "kind int, h long, c long").groupBy("kind", "h").agg(F.sum("c").alias("c"))
        found = written(found, "gram-counts")
        self.total = float(found.where("kind = 2").agg(F.sum("c")).first()[0] or 0)
        self.words, self.grams = self._top(found, 0, TOP_WORDS), self._top(found, 1, TOP_GRAMS)
        self.rare = float(self.words.count.min()) if 2 * len(self.words.h) > TOP_WORDS else max(1.0, self.total * LEAST / COUNT_WORDS / 2)

    def release(self) -> None:
        """Drop the tables that were built here; a worker outlives its task."""
        self.words._tables.clear()
        self.grams._tables.clear()
        trim()

    @staticmethod
    def _top(found: DataFrame, kind: int, most: int) -> Counts:
        """The largest counts: all from a bound on, which a small histogram gives, so that no more than `most` rows leave the tasks."""
        rows = found.where(F.col("kind") == kind).withColumn("size", F.floor(F.log2("c") * 16))
        total, least = 0, None
        for size, n in sorted(rows.groupBy("size").count().collect(), reverse=True):
            total += n
            if total > most:
                break
            least = size
        rows = rows.where(F.col("size") >= (least if least is not None else 1 << 20)).select("h", "c").toArrow()
        return Counts(rows["h"].to_numpy().astype(np.int64).view(U), rows["c"].to_numpy())

    def sets(self, b: Block) -> Iterator[tuple[int, np.ndarray]]:
        """The number of each text in the block with words, and its set as ascending keys: 8 bits of frequency, 56 of hash.

        A level depends on an n-gram's words alone, so equal n-grams have equal keys in every text.
        """
        h, g, valid = gram_hashes(b, self.n)
        f = self.words.of(h, self.rare)
        guess = f.copy()
        for k in range(1, self.n):
            guess[: max(0, len(f) - k)] *= f[k:] / np.float32(max(1.0, self.total))
        count = self.grams.of(g, 0.0)
        guess = np.where(count > 0, count, np.maximum(guess, np.float32(2**-16)))
        level = np.clip((guess.view(np.int32) >> 21) - (111 << 2), 1, 255).astype(U)  # four for each doubling
        level[np.repeat(np.diff(b.cut) < self.n, np.diff(b.cut))] = 0
        yield from _distinct(b, (level << U(56)) | (g >> U(8)), valid)


def _distinct(b: Block, key: np.ndarray, valid: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for i in np.flatnonzero(np.diff(b.cut)):
        lo, hi = b.cut[i], b.cut[i + 1]
        yield i, np.unique(key[lo:hi][valid[lo:hi]])


def plain_sets(b: Block, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """The sets as ascending hashes of 56 bits, without the order."""
    _, g, valid = gram_hashes(b, n)
    yield from _distinct(b, g >> U(8), valid)


def signature(keys: np.ndarray) -> int:
    """63 bits that name a set, with or without the order's bits."""
    total = (int(mix(keys & U(2**56 - 1)).sum(dtype=U)) + len(keys) * 0x9E3779B97F4A7C15) % 2**64
    return int(mix(np.array([total], U))[0] >> U(1))


def family(own: np.ndarray, percent: int) -> int:
    """A name that near copies mostly share: of the two smallest hashes of a set's first members, those of many texts if there are such, and
    of about its size; 0 for none. Any name gives right results."""
    first = own[: prefix(len(own), percent)]
    many = first[np.searchsorted(first, U(FREQUENT << 56)) :]
    first = many if len(many) > 1 else first
    if len(first) < 2:
        return 0
    low = np.partition(mix(first), 1)[:2]
    size = U(int(np.log(len(own)) / np.log(NODE_SIZES)))
    return int(mix(low[:1] ^ mix(low[1:] + size))[0] >> U(1))


def sketch(keys: np.ndarray) -> bytes:
    """For each of 2 n to 4 n classes of hashes a bit, whether an odd number of the n members falls there. Two sets differ in as many members at
    least as their sketches in bits."""
    m = max(64, 1 << (2 * len(keys) - 1).bit_length())
    return np.packbits((np.bincount((keys & U(m - 1)).astype(np.int64), minlength=m) & 1).astype(bool)).tobytes()


def differing(a: bytes, b: bytes) -> int:
    """In how many bits two sketches differ; the longer one is folded to the length of the other."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    if len(y) > len(x):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _near(percent: int):  # noqa: ANN202
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = (batch.column("n_a").fill_null(0).to_numpy() + batch.column("n_b").fill_null(0).to_numpy()).tolist()
            keep = []
            for x, y, n in zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), total, strict=True):
                share = -(-percent * n // (100 + percent))
                keep.append(x is None or y is None or differing(x, y) <= n - 2 * share)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return near


def _names(order: Order, percent: int):  # noqa: ANN202
    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, size, name = (np.zeros(len(batch), np.int64) for _ in range(3))
            bits = [b""] * len(batch)
            for b in blocks(batch.column(1), lower=True):
                for i, keys in order.sets(b):
                    sig[b.first + i], size[b.first + i], name[b.first + i] = signature(keys), len(keys), family(keys, percent)
                    bits[b.first + i] = sketch(keys)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "sig": pa.array(sig), "n": pa.array(size), "name": pa.array(name), "bits": pa.array(bits, pa.binary())})
        order.release()

    return names


class Nodes:
    """The node of a class by its family's name; a family of over BLOCK classes is split by hash."""

    def __init__(self, hot: pa.Table):
        name, splits = hot["name"].to_numpy(), hot["splits"].to_numpy()
        order = np.argsort(name)
        self.name, self.splits = name[order], splits[order]

    def of(self, name: np.ndarray, sig: np.ndarray) -> np.ndarray:
        node = np.where(name == 0, sig, name)
        if len(self.name):
            at = np.minimum(np.searchsorted(self.name, name), len(self.name) - 1)
            hot = np.flatnonzero(self.name[at] == name)
            split = mix(sig[hot].view(U)) % self.splits[at[hot]].astype(U)
            node[hot] = (mix(name[hot].view(U) + split) >> U(1)).view(np.int64)
        return node


def _nodes(nodes: Nodes):  # noqa: ANN202
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = nodes.of(batch.column("name").to_numpy(), batch.column("sig").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node)], [*batch.schema.names, "node"])

    return of


def prefix(n: int, percent: int) -> int:
    """Members of a set of n of which any set that links with it has one among its own first ones."""
    return n - -(-percent * n // 100) + 1


def _postings(order: Order, nodes: Nodes, percent: int, parts: np.ndarray):  # noqa: ANN202
    r = len(parts)

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task sends each class once, however many copies it holds
        docs: list[tuple[int, int, int]] = []
        keys: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not docs:
                return
            table = np.array(docs, np.int64)
            node = nodes.of(table[:, 2], table[:, 0])
            key = np.concatenate(keys)
            doc = np.repeat(np.arange(len(docs), dtype=np.uint32), [len(k) for k in keys])
            part = mix(key) % U(r)
            rows: dict[str, list] = {c: [] for c in ("part", "keys", "docs", "nodes", "sizes")}
            for p, (k, d) in enumerate(split_by(part.astype(np.int64), r, key, doc)):
                if len(k):
                    used, at = np.unique(d, return_inverse=True)
                    k = mix(k)  # 48 bits do for candidates: a false match only adds a pair that the exact product rejects
                    rows["part"].append(parts[p])
                    rows["keys"].append((k >> U(32)).astype(np.uint32).tobytes() + (k >> U(16)).astype(np.uint16).tobytes())
                    rows["docs"].append(at.astype(np.uint32 if len(used) > 65535 else np.uint16).tobytes())
                    rows["nodes"].append(node[used].tobytes())
                    rows["sizes"].append(table[used, 1].astype(np.uint32).tobytes())
            docs.clear()
            keys.clear()
            yield pa.RecordBatch.from_pydict({"part": pa.array(rows["part"], pa.int32())} | {c: pa.array(rows[c], pa.binary()) for c in ("keys", "docs", "nodes", "sizes")})

        for batch in batches:
            for b in blocks(batch.column(0), lower=True):
                for _, own in order.sets(b):
                    sig = signature(own)
                    if sig not in seen:
                        seen.add(sig)
                        docs.append((sig, len(own), family(own, percent)))
                        keys.append(own[: prefix(len(own), percent)])
                        size += len(keys[-1])
                if size >= 1_000_000:
                    yield from flush()
                    size = 0
        yield from flush()
        order.release()

    return postings


def least_common(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """How many common members the prefixes of linked sets of sizes a and b have at least."""
    share = -(-percent * (a + b) // (100 + percent))
    return np.maximum(1, 1 + share - np.maximum(-(-percent * a // 100), -(-percent * b // 100)))


def least_of_nodes(low: np.ndarray, high: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """The same for nodes i and j with sets of low to high members: the least over their sets, or less."""
    a, b, c, d = low[i], high[i], low[j], high[j]
    bound = lambda large, small: -(-percent * (100 * small - percent * large) // (100 * (100 + percent)))
    return np.where((a == b) & (c == d), least_common(a, c, percent), np.maximum(1, np.minimum(bound(b, c), bound(d, a))))


def dropped(need: np.ndarray, r: int) -> np.ndarray:
    """The count up to which one of r blocks drops a pair that needs so many: all of them drop at most three quarters of that."""
    return 3 * need // (4 * r)


def least_kept(need: Column, r: int) -> Column:
    """What is left at least of the count of a linked pair that needs so many or more. A need of n loses r x dropped(n): nothing below 4 r / 3, and
    beyond at most 3 n / 4."""
    return F.least(need, F.greatest(F.ceil(need / 4), F.lit(-(-r // 3))))


def overlaps(packed: np.ndarray, bits: int, size: np.ndarray, percent: int, most: int = 2_000_000, largest: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of documents and the number of keys they share, in batches, each pair once; pairs whose sizes rule a link out are left out.

    packed: a key and below it `bits` bits of a document's number, for each member. Documents are numbered by size, so within a run of one
    key the partners of a document end where they get too large. Nodes in place of documents have a smallest size and a largest one.
    """
    largest = size if largest is None else largest
    packed.sort()
    mask, shift, n = U((1 << bits) - 1), U(bits), U(len(size))
    packed = packed[np.append(True, packed[1:] != packed[:-1])] if len(packed) else packed
    same = (packed[1:] >> shift) == (packed[:-1] >> shift)
    packed = packed[np.append(same, False) | np.append(False, same)]
    if not len(packed):
        return
    last = np.append(np.flatnonzero((packed[1:] >> shift) != (packed[:-1] >> shift)), len(packed) - 1)
    end = np.repeat(last + 1, np.diff(last, prepend=-1))  # of the run
    # By the smaller document of a pair, in groups of about `most` pairs, so that its count is whole.
    by = np.argsort(packed & mask, kind="stable")
    partners = np.cumsum((end - np.arange(len(packed)) - 1)[by])
    begins = np.append(0, np.flatnonzero(np.diff((packed & mask)[by])) + 1)
    group = partners[begins] // most
    cuts = [*begins[np.append(True, group[1:] != group[:-1])].tolist(), len(by)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        live, held, step = np.sort(by[lo:hi]), [np.zeros(0, U)], 1
        while len(live):
            live = live[live + step < end[live]]
            a, b = packed[live] & mask, packed[live + step] & mask
            fits = 100 * largest[a] >= percent * size[b]
            live, a, b = live[fits], a[fits], b[fits]
            held.append(a * n + b)
            step += 1
        code, count = np.unique(np.concatenate(held), return_counts=True)
        yield (code // n).astype(np.int64), (code % n).astype(np.int64), count


def _candidates(percent: int, r: int):  # noqa: ANN202
    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        if not rows:
            return
        nodes = [np.frombuffer(row["nodes"], np.int64) for row in rows]
        names, of = np.unique(np.concatenate(nodes), return_inverse=True)
        size = np.concatenate([np.frombuffer(row["sizes"], np.uint32) for row in rows]).astype(np.int64)
        low, high = np.full(len(names), size.max()), np.zeros(len(names), np.int64)
        np.minimum.at(low, of, size)
        np.maximum.at(high, of, size)
        order = np.argsort(low, kind="stable")
        names, low, high, number = names[order], low[order], high[order], np.argsort(order)
        bits = max(1, int(len(names) - 1).bit_length())
        packed, base = [], 0
        for row, s in zip(rows, nodes, strict=True):
            raw, own = row.pop("keys"), number[of[base : base + len(s)]].astype(U)
            key = unpacked48(raw)
            packed.append((key << U(bits)) | own[np.frombuffer(row.pop("docs"), np.uint16 if len(s) <= 65535 else np.uint32)])
            base += len(s)
        rows, nodes, packed = [], [], np.concatenate(packed)
        for i, j, k in overlaps(packed, bits, low, percent, largest=high):
            need = least_of_nodes(low, high, i, j, percent)
            kept = k > dropped(need, r)
            i, j, k, need = i[kept], j[kept], k[kept], need[kept]
            for at in range(0, len(i), 200_000):
                a, b, c, least = (x[at : at + 200_000] for x in (names[i], names[j], k, need))
                yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b)), "need": pa.array(least.astype(np.int32)), "c": pa.array(np.minimum(c, least).astype(np.int32))})
        del packed
        trim()

    return candidates


def packed48(keys: np.ndarray) -> bytes:
    """48 of the 56 bits of each member: two sets of 20,000 words share one by chance once in a million pairs."""
    k = keys >> U(8)
    return (k >> U(16)).astype(np.uint32).tobytes() + k.astype(np.uint16).tobytes()


def unpacked48(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    return (np.frombuffer(raw[: 4 * n], np.uint32).astype(U) << U(16)) | np.frombuffer(raw[4 * n :], np.uint16)


def _slot(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(U)) % U(SLOTS)).astype(np.int64)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"slot": pa.array(np.unique(_slot(batch.column(0).to_numpy())).astype(np.int32))})


class Rooms:
    """Where the sets of classes go, with their nodes and how many rows have them."""

    def __init__(self, rows: pa.Table):
        sig, room = rows["sig"].to_numpy(), rows["room"].to_numpy()
        order = np.lexsort((room, sig))
        self.sig, self.room = sig[order], room[order].astype(np.int32)
        self.node, self.class_size = (rows[c].to_numpy()[order] for c in ("node", "class_size"))

    def of(self, sig: int) -> Iterator[tuple[int, int, int]]:
        i, j = np.searchsorted(self.sig, [sig, sig + 1])
        return zip(*(x[i:j].tolist() for x in (self.room, self.node, self.class_size)), strict=True)


def _whole(n: int, wanted: np.ndarray, rooms: Rooms | None = None):  # noqa: ANN202
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0)
            keep = wanted[_slot(ids.fill_null(0).to_numpy(zero_copy_only=False))] | ids.is_null().to_numpy(zero_copy_only=False)
            for b in blocks(batch.column(1).filter(pa.array(keep)), lower=True):
                sigs, sets, places = [], [], []
                for _, keys in plain_sets(b, n):
                    sig = signature(keys)
                    if sig not in seen:
                        seen.add(sig)
                        for place in [(-1, 0, 0)] if rooms is None else rooms.of(sig):
                            places.append(place)
                            sigs.append(sig)
                            sets.append(packed48(keys))
                room, node, size = zip(*places, strict=True) if places else ((), (), ())
                yield pa.RecordBatch.from_pydict({"room": pa.array(room, pa.int32()), "sig": pa.array(sigs, pa.int64()), "node": pa.array(node, pa.int64()), "class_size": pa.array(size, pa.int64()), "members": pa.array(sets, pa.binary())})

    return whole


def product(sets: list[np.ndarray], chunk: int = 8192) -> np.ndarray:
    """Numbers of common members of all pairs of sets: the incidence matrix times its transpose, by blocks of columns."""
    m = len(sets)
    out = np.zeros((m, m), np.float32)
    doc = np.repeat(np.arange(m), [len(s) for s in sets])
    _, col, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1  # a column of one member adds nothing off the diagonal
    number = np.cumsum(shared) - 1
    keep = shared[col]
    doc, col = doc[keep], number[col[keep]]
    order = np.argsort(col, kind="stable")
    doc, col = doc[order], col[order]
    for lo in range(0, int(shared.sum()), chunk):
        i, j = np.searchsorted(col, [lo, lo + chunk])
        part = np.zeros((m, chunk), np.float32)
        part[doc[i:j], col[i:j] - lo] = 1
        out += part @ part.T
    return out.astype(np.int64)


def joined(ok: np.ndarray) -> np.ndarray:
    """The first row of each row's component, of a symmetric matrix of links."""
    root = np.arange(len(ok))
    while True:
        low = np.minimum(root, np.where(ok, root, len(ok)).min(axis=1, initial=len(ok)))
        new = low[low]
        if (new == root).all():
            return root
        root = new


def _links(percent: int):  # noqa: ANN202
    def links(pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        sets = sets.drop_duplicates("sig").sort_values(["node", "sig"])
        sig, node, rows, members = (sets[c].to_numpy() for c in ("sig", "node", "class_size", "members"))
        out = []
        for _, p in pairs.groupby("block", sort=True):
            a, b = p.a.to_numpy(), p.b.to_numpy()
            names = np.unique(np.concatenate([a, b]))
            lo, hi = np.searchsorted(node, names), np.searchsorted(node, names, "right")
            at = np.concatenate([np.arange(x, y) for x, y in zip(lo, hi, strict=True)])
            own = [unpacked48(m) for m in members[at]]
            size, of = np.array([len(s) for s in own]), np.repeat(np.arange(len(names)), hi - lo)
            met = np.zeros((len(names), len(names)), bool)  # other pairs of these nodes have other blocks, or none
            i, j = np.searchsorted(names, a), np.searchsorted(names, b)
            met[i, j] = met[j, i] = True
            ok = (100 + percent) * product(own) >= percent * (size[:, None] + size)
            ok &= met[of[:, None], of]
            np.fill_diagonal(ok, False)
            linked, root = ok @ rows[at], joined(ok)
            some = np.flatnonzero(linked)
            out.append(pd.DataFrame({"sig": sig[at[some]], "root": sig[at[root[some]]], "linked": linked[some]}))
        trim()
        return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("sig", "root", "linked")})

    return links


def link_classes(docs: DataFrame, classes: DataFrame, order: Order, percent: int, room_rows: int = ROOM_ROWS) -> DataFrame:
    """sig, root, linked: of the classes of docs (doc_id, text) that link with others, the number of rows in those others and a class of the same
    component, by blocks. A class has a row for each block in which it links, and each pair of classes meets in one block; written."""
    spark = docs.sparkSession
    hot = classes.where("name <> 0").groupBy("name").agg(F.ceil(F.count("*") / BLOCK).alias("splits")).where("splits > 1")
    nodes = Nodes(hot.toArrow())
    sketches = classes.select("sig", "bits")
    classes = classes.drop("bits")
    classes = written(classes.mapInArrow(_nodes(nodes), StructType([*classes.schema.fields, StructField("node", LongType())])), "nodes")
    held = written(classes.groupBy("node").agg(F.count("*").alias("held"), F.max("sig").alias("sig"), F.max("n").alias("n")), "held")
    parts = part_keys(shuffle_partitions(spark, order.total * (100 - percent) / 100, 8e6))
    postings = docs.select("text").mapInArrow(_postings(order, nodes, percent, parts), "part int, keys binary, docs binary, nodes binary, sizes binary")
    found = to_parts(postings, len(parts)).mapInArrow(_candidates(percent, len(parts)), "a long, b long, need int, c int")
    found = found.groupBy("a", "b").agg(F.sum("c").alias("c"), F.min("need").alias("need"))
    found = found.where(F.col("c") >= least_kept(F.col("need"), len(parts))).select("a", "b")
    alone = held.where("held = 1").join(sketches, "sig")
    of = lambda c: alone.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    found = found.join(of("a"), "a", "left").join(of("b"), "b", "left").mapInArrow(_near(percent), "a long, b long")
    several = held.where("held > 1").select(F.col("node").alias("a"), F.col("node").alias("b"))
    pairs = written(found.union(several), "candidates")

    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lead = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("lead"))
    lead = lead.join(held.select("node", "held"), "node")
    small = F.col("held") < BLOCK // 2  # others are homes of their own
    crowd = lead.where(small).groupBy("lead").agg(F.ceil(F.sum("held") / BLOCK).alias("blocks"))
    home = F.when(small, F.xxhash64("lead", F.pmod(F.xxhash64("node"), F.col("blocks")))).otherwise(F.col("node"))
    home = lead.join(crowd, "lead", "left").select("node", home.alias("home"))
    home = written(home, "homes")  # near copies share a leader, so they meet in few blocks
    inside = home.join(classes, "node")
    volume = inside.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not volume:
        return spark.createDataFrame([], "sig long, root long, linked long")
    # A class is read from the rows with its smallest doc_id, which a bit table of fixed size finds; what it lets by in excess, the
    # join on the class leaves out.
    wanted = np.zeros(SLOTS, bool)
    ids = inside.where("class_id is not null").select("class_id")
    for part in ids.mapInArrow(_slots, "slot int").distinct().toArrow().column("slot").chunks:
        wanted[part.to_numpy()] = True

    side = lambda c: home.select(F.col("node").alias(c), F.col("home").alias(f"home_{c}"))
    placed = pairs.join(side("a"), "a").join(side("b"), "b")
    placed = placed.select("a", "b", F.xxhash64(F.least("home_a", "home_b"), F.greatest("home_a", "home_b")).alias("block"))
    buckets = shuffle_partitions(spark, 8 * volume, 24e6)
    placed = written(placed.withColumn("bucket", F.pmod("block", F.lit(buckets)).cast("int")), "placed")
    needed = placed.select(F.col("bucket").alias("room"), F.explode(F.array("a", "b")).alias("node")).distinct()
    needed = written(needed.join(classes, "node").select("room", "sig", "node", "class_size"), "needed")
    if needed.count() <= room_rows:
        sets = docs.mapInArrow(_whole(order.n, wanted, Rooms(needed.toArrow())), "room int, sig long, node long, class_size long, members binary")
    else:
        sets = docs.mapInArrow(_whole(order.n, wanted), "room int, sig long, node long, class_size long, members binary").select("sig", "members")
        sets = needed.join(sets, "sig").select("room", "sig", "node", "class_size", "members")
    # Tasks that meet a class send its set once each; equal sets meet under one name in the function.
    done = placed.groupBy("bucket").cogroup(sets.groupBy("room")).applyInPandas(_links(percent), "sig long, root long, linked long")
    return written(done, "links")


def components(edges: DataFrame, driver_edges: int = DRIVER_EDGES) -> DataFrame:
    """node and root, the smallest node of its component, of the nodes of edges (a, b). Up to driver_edges edges are joined up on
    the driver; beyond, labels spread by joins, with pointer jumping, each round written to the shared folder."""
    spark = edges.sparkSession
    if edges.count() <= driver_edges:
        e = edges.select("a", "b").toArrow()
        nodes, at = np.unique(np.concatenate([e["a"].to_numpy(), e["b"].to_numpy()]).astype(np.int64), return_inverse=True)
        i, j, root = at[: len(e)], at[len(e) :], np.arange(len(nodes))
        while True:
            low = np.minimum(root[i], root[j])
            new = root.copy()
            np.minimum.at(new, root[i], low)
            np.minimum.at(new, root[j], low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        out = pa.table({"node": pa.array(nodes, pa.int64()), "root": pa.array(nodes[root] if len(nodes) else nodes, pa.int64())})
        return spark.createDataFrame(out) if len(nodes) else spark.createDataFrame([], "node long, root long")
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "roots")
    while True:
        near = both.join(roots, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        step = roots.join(near, F.col("node") == F.col("a")).select("node", "root", F.least("root", "near").alias("low"))
        up = step.select(F.col("node").alias("root_node"), F.col("low").alias("up"))
        jump = step.join(up, F.col("low") == F.col("root_node")).select("node", "root", F.least("low", "up").alias("new"))
        new = written(jump, "roots")
        changed = new.where("new <> root").limit(1).count()
        roots = new.select("node", F.col("new").alias("root"))
        if not changed:
            return roots


def classes_of(docs: DataFrame, percent: int, n: int) -> tuple[DataFrame, DataFrame]:
    """Of docs (doc_id, text): the class and size of each row's set; and of each class its first doc_id, rows, similar documents and
    component. Both written."""
    order = Order(docs, n)
    named = written(docs.mapInArrow(_names(order, percent), "doc_id long, sig long, n long, name long, bits binary"), "named")
    classes = written(named.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), F.max("n").alias("n"), F.max("name").alias("name"), F.first("bits").alias("bits")), "classes")
    links = link_classes(docs, classes, order, percent)
    others = links.groupBy("sig").agg(F.sum("linked").alias("linked"))
    roots = components(links.where("sig <> root").select(F.col("sig").alias("a"), F.col("root").alias("b")))
    inside = roots.join(classes, F.col("node") == F.col("sig")).select("sig", "root", "class_id")
    smallest = inside.groupBy("root").agg(F.min("class_id").alias("component_id"), F.min("sig").alias("first_sig"))
    in_component = inside.join(smallest, "root").select("sig", "component_id", "first_sig")
    known = classes.join(others, "sig", "left").join(in_component, "sig", "left").select(
        "sig", "class_id", "class_size", (F.col("class_size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_similar"),
        F.when(F.col("first_sig").isNull(), F.col("class_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("first_sig", "sig").alias("first_sig"),
    )
    return named, written(known, "known")


def similar(docs: DataFrame, percent: int = 60, n: int = 2) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, n_similar, component_id, class_id (the smallest doc_id of the same set) and
    class_size.

    The set of a text has its distinct n-word shingles, lower-cased in A-Z; of fewer words the whole sequence; a null text, or one
    without words, has none, links with nothing and is its own component. Repeated rows link with each other. A row with a null
    doc_id takes part, but names no component unless all in it are null. An empty table gives an empty result. Other columns are
    ignored. Sets are named by 63-bit hashes.
    """
    start(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named, known = classes_of(docs, percent, n)
    of_docs = salted_join(named.where("n > 0"), known, "sig", F.col("doc_id"), counts=known.select("sig", F.col("class_size").alias("count")))
    columns = ("doc_id", F.col("n").alias("n_shingles"), "n_similar", "component_id", "class_id", "class_size")
    zero = F.lit(0).cast("long")
    alone = named.where("n = 0").select("doc_id", zero.alias("n_shingles"), zero.alias("n_similar"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return of_docs.select(*columns).unionByName(alone)


def similar_rows(docs: DataFrame, percent: int = 60, n: int = 2, broadcast_rows: int = 500_000) -> DataFrame:
    """docs without near duplicates, with their columns: of each component the row with the smallest doc_id stays (of several
    equal ones, or where all are null, one), and rows without words stay, all of them. Cases are as in similar.

    What goes is named by class and doc_id: broadcast where it has at most broadcast_rows rows, else joined on both, which no copies
    share."""
    start(docs)
    named, known = classes_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), percent, n)
    held = named.where("n > 0").groupBy("sig", "doc_id").agg(F.count("*").alias("times"))  # combined before the shuffle
    held = salted_join(held, known.select("sig", "class_id", "component_id", "first_sig"), "sig", F.col("doc_id"), counts=known.select("sig", F.col("class_size").alias("count")))
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & F.when(F.col("component_id").isNull(), F.col("sig") == F.col("first_sig")).otherwise(F.col("class_id") == F.col("component_id"))
    decided = written(held.select("sig", "doc_id", "times", first.alias("stays")), "decided")
    gone = decided.where("not stays").select(F.col("sig").alias("_s"), F.col("doc_id").alias("_d"))
    again = decided.where("stays and times > 1").select(F.col("sig").alias("_s"), F.col("doc_id").alias("_d"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("_id"))
    rows = rows.mapInArrow(_signed(n), StructType([*rows.schema.fields, StructField("_sig", LongType())]))
    same = (F.col("_sig") == F.col("_s")) & F.col("_id").eqNullSafe(F.col("_d"))
    small = gone.count() <= broadcast_rows
    out = rows.join(F.broadcast(gone) if small else gone, same, "left_anti")
    if again.take(1):
        one = out.join(again, same, "left_semi").dropDuplicates(["_sig", "_id"])
        out = out.join(again, same, "left_anti").unionByName(one)
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def _signed(n: int):  # noqa: ANN202
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.zeros(len(batch), np.int64)
            for b in blocks(text_of(batch.column(0)), lower=True):
                for i, keys in plain_sets(b, n):
                    sig[b.first + i] = signature(keys)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sig)], [*batch.schema.names, "_sig"])

    return signed


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS s FROM words),
rows AS (SELECT doc_id, unnest(s) AS g FROM shingles),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM rows a JOIN rows b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN shingles x ON x.doc_id = a JOIN shingles y ON y.doc_id = b WHERE 100 * n >= 60 * (len(x.s) + len(y.s) - n)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM shingles UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id),
degree AS (SELECT a AS doc_id, count(*) AS n_similar FROM links GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CAST(coalesce(d.n_similar, 0) AS BIGINT) AS n_similar, l.component_id
FROM shingles s JOIN lowest l USING (doc_id) LEFT JOIN degree d USING (doc_id)
"""
