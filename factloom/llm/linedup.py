"""Line dedup by pairwise alignment.

Documents meet through windows: the shortest runs of lines with enough words for a block, so two documents without a common window have no
common block. Each document is first aligned with the first holder of each of its windows, which settles most of them with n - 1 pairs for n holders.
A window with a line that is not deleted yet then meets all its other earlier holders, but those that look alike to the document (equal after
each run of lines that it lacks is taken as one) are aligned once; so the result is that of alignment with all earlier documents. A pair is aligned by patience diff on its rare lines
(once in each of both), which gives common blocks; blocks of enough words are deleted from the later document. Documents of the same
lines form a class that is aligned once; later copies in a class go altogether.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from factloom.llm.blocks import Block, U, blocks, mix, span_hashes
from factloom.llm.shared import salted_join, start, written

LINES = "doc_id long, sig long, lines binary, words binary"
#: So many holders of a window, and documents that it is open in, meet in one task; more are cut into blocks that all meet.
BLOCK = 10_000


def _bounds(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each \\n-split line its text, its first word, and the one after its last."""
    newline = np.flatnonzero(b.buf == 10)
    doc = np.concatenate([np.searchsorted(b.off, newline, "right") - 1, np.arange(b.n)])
    ends = np.concatenate([newline, b.off[1:]])
    order = np.lexsort((ends, doc))
    last = np.searchsorted(b.end, ends[order], "right")
    return doc[order], np.concatenate([[0], last[:-1]]), last


def line_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each text its number, the hash of each line without outer white space (0 for a line without words), and its words."""
    for b in blocks(column):
        doc, first, last = _bounds(b)
        full = np.flatnonzero(last > first)
        h = np.zeros(len(doc), U)
        if len(full):
            h[full] = np.maximum(span_hashes(b.buf, b.start[first[full]], b.end[last[full] - 1]), U(1))
        words = (last - first).astype(np.int32)
        at = np.searchsorted(doc, np.arange(b.n + 1))
        for i in range(b.n):
            yield b.first + i, h[at[i] : at[i + 1]], words[at[i] : at[i + 1]]


def signature(h: np.ndarray) -> int:
    """63 bits that name a sequence of lines; 0 for one without words."""
    held = h[h != 0]
    place = mix(held + np.arange(1, len(held) + 1, dtype=U) * U(0x9E3779B97F4A7C15))
    return int(mix(np.array([place.sum(dtype=U)], U))[0] >> U(1)) | 1 if len(held) else 0


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sig, lines, words = [], [], []
        for _, h, w in line_hashes(batch.column(1)):
            sig.append(signature(h))
            lines.append(h.tobytes())
            words.append(w.tobytes())
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "sig": pa.array(sig, pa.int64()), "lines": pa.array(lines, pa.binary()), "words": pa.array(words, pa.binary())})


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Positions of a longest increasing subsequence."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[k], at[k] = v, i
        back[i] = at[k - 1] if k else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Aligned equal lines of a and b, ascending in both: lines that are unique in each side of a section anchor it along a longest
    increasing subsequence, matches spread from the anchors while lines stay equal, and the sections between are treated alike."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {a[i]: i for i in range(a0, a1) if in_a[a[i]] == 1}
        pairs = [(where[b[j]], j) for j in range(b0, b1) if in_b[b[j]] == 1 and b[j] in where]
        if not pairs:
            continue
        i, j = a0, b0
        for k in longest_increasing([p[0] for p in pairs]):
            x, y = pairs[k]
            todo.append((i, x, j, y))
            out.append((x, y))
            i, j = x + 1, y + 1
        todo.append((i, a1, j, b1))
    return sorted(out)


def common_blocks(a: np.ndarray, b: np.ndarray, words: np.ndarray, min_words: int) -> list[int]:
    """Lines of b in aligned common blocks with a of at least min_words words; words: of b's lines. Lines without words (0) belong to
    no block and break none."""
    rows = np.flatnonzero(b)
    pairs = patience(a[a != 0].tolist(), b[rows].tolist())
    out: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for pair in [*pairs, (-9, -9)]:
        if pair != (last[0] + 1, last[1] + 1):
            if words[block].sum() >= min_words:
                out += block
            block = []
        block.append(int(rows[pair[1]])) if pair[1] >= 0 else None
        last = pair
    return out


def windows(h: np.ndarray, words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first line of each window, the one after its last, and its hash. A window is a run of lines (without those that have no words) of
    at least min_words words, as short as it can be from its first line or from its last one. The windows in a block cover it."""
    rows = np.flatnonzero(h)
    h, least = h[rows], max(min_words, 1)
    c = np.concatenate([[0], np.cumsum(words[rows], dtype=np.int64)])
    ends, starts = np.searchsorted(c, c[:-1] + least), np.searchsorted(c, c[1:] - least, "right") - 1
    a = np.concatenate([np.flatnonzero(ends < len(c)), starts[starts >= 0]])
    b = np.concatenate([ends[ends < len(c)], np.flatnonzero(starts >= 0) + 1])
    out = np.zeros(len(a), U)
    for k in range(int((b - a).max(initial=0))):
        on = a + k < b
        out[on] = mix(out[on] * U(3) + h[a[on] + k] + U(k))
    return rows[a], rows[b - 1] + 1, out


def _members(min_words: int):  # noqa: ANN202
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, ids, hashes = [], [], [np.zeros(0, np.int64)]
            for sig, first, raw, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = np.unique(windows(np.frombuffer(raw, U), np.frombuffer(words, np.int32), min_words)[2]).view(np.int64)
                sigs += [sig] * len(h)
                ids += [first] * len(h)
                hashes.append(h)
            yield pa.RecordBatch.from_pydict({"sig": pa.array(sigs, pa.int64()), "first_id": pa.array(ids, pa.int64()), "line": pa.array(np.concatenate(hashes), pa.int64())})

    return members


def _open(min_words: int):  # noqa: ANN202
    """Of the windows of each class those with a line that is not deleted."""

    def still(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            sigs, out = [], [np.zeros(0, np.int64)]
            for sig, held, raw, w, removed in zip(p.sig, p.held, p.lines, p.words, p.removed, strict=True):
                h = np.frombuffer(raw, U)
                left = h != 0
                for part in removed if removed is not None else []:
                    left[np.frombuffer(part, np.int32)] = False
                a, b, name = windows(h, np.frombuffer(w, np.int32), min_words)
                c = np.append(0, np.cumsum(left))
                name = np.intersect1d(name[c[b] > c[a]].view(np.int64), np.asarray(held, np.int64))
                sigs.append(np.full(len(name), sig))
                out.append(name)
            yield pd.DataFrame({"sig": np.concatenate([out[0], *sigs]), "line": np.concatenate(out)})

    return still


def _seen(lines: Sequence[int], own: set[int]) -> tuple[int, ...]:
    """Lines as a document with the lines `own` meets them: each run of others is one 0."""
    out: list[int] = []
    for x in lines:
        if x in own:
            out.append(x)
        elif not out or out[-1]:
            out.append(0)
    return tuple(out)


def _rest(min_words: int):  # noqa: ANN202
    """The documents (right) in which a window is open against its earlier holders (left)."""

    def rest(holders: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        sigs, removed = [], []
        if len(holders) and len(docs):
            rank = lambda p: [(pd.isna(i), 0 if pd.isna(i) else int(i), s) for i, s in zip(p.first_id, p.sig, strict=True)]
            name = np.array([docs.line[0]], np.int64).view(U)[0]
            todo = []
            for r, sig, raw, w in zip(rank(docs), docs.sig, docs.lines, docs.words, strict=True):
                h, words = np.frombuffer(raw, U), np.frombuffer(w, np.int32)
                a, b, names = windows(h, words, min_words)
                spots = {k for i in np.flatnonzero(names == name) for k in range(a[i], b[i]) if h[k]}
                todo.append((r, sig, h, words, set(h[h != 0].tolist()), spots, {int(h[k]) for k in spots}))
            known = set().union(*[x[4] for x in todo])
            other = next(i for i in range(1, len(known) + 2) if i not in known)
            # Holders that look alike to all of these documents count once, as the first of them.
            shapes: dict[tuple[int, ...], tuple] = {}
            for r, raw in sorted(zip(rank(holders), holders.lines, strict=True)):
                h = np.frombuffer(raw, U)
                shapes.setdefault(_seen(h[h != 0].tolist(), known), r)
            shape, ranks = list(shapes), list(shapes.values())
            post: dict[int, list[int]] = {}
            for i, x in enumerate(shape):
                for line in set(x):
                    post.setdefault(line, []).append(i)
            plain: dict[frozenset, dict[tuple[int, ...], list[int]]] = {}
            for r, sig, h, words, own, spots, its in todo:
                end = bisect_left(ranks, r)
                if (key := frozenset(its)) not in plain:
                    plain[key] = {}
                    for i, x in enumerate(shape):
                        plain[key].setdefault(_seen(x, its), []).append(i)
                # Holders with more than the window in common are looked at one by one, of the others one for each look.
                more = {i for line in own - its for i in post.get(line, ())[: bisect_left(post.get(line, ()), end)]}
                looks = {_seen(shape[i], own) for i in more}
                looks |= {x for x, held in plain[key].items() if next((i for i in held if i not in more), end) < end}
                gone: set[int] = set()
                for x in sorted(looks):
                    gone.update(common_blocks(np.array([y or other for y in x], U), h, words, min_words))
                    if spots <= gone:
                        break
                if gone:
                    sigs.append(sig)
                    removed.append(np.array(sorted(gone), np.int32).tobytes())
        return pd.DataFrame({"sig": np.array(sigs, np.int64), "removed": removed})

    return rest


def _aligned(min_words: int):  # noqa: ANN202
    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            sigs, removed, sets = [], [], {}
            for sig, x, y, w in zip(p.sig, p.first_lines, p.lines, p.words, strict=True):
                if x not in sets:
                    sets[x] = set(np.frombuffer(x, U).tolist())
                b, words = np.frombuffer(y, U), np.frombuffer(w, np.int32)
                rows = [i for i, line in enumerate(b.tolist()) if line and line in sets[x]]
                if words[rows].sum() < min_words:  # no block can be long enough
                    continue
                rows = common_blocks(np.frombuffer(x, U), b, words, min_words)
                if rows:
                    sigs.append(sig)
                    removed.append(np.array(rows, np.int32).tobytes())
            yield pd.DataFrame({"sig": np.array(sigs, np.int64), "removed": removed})

    return aligned


def removals(docs: DataFrame, min_words: int, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The lines of docs (doc_id, text), and for each class (sig) the positions of lines to delete from its first document; both written."""
    lined = written(docs.mapInArrow(_lines, LINES), "lines")
    # One row for each class: the lines of its first document. No group is gathered: min_by is combined before the shuffle.
    order = F.struct(F.col("doc_id").isNull(), "doc_id")
    classes = lined.where("sig <> 0").groupBy("sig").agg(F.min_by(F.struct("lines", "words"), order).alias("x"), F.min(order).alias("o"), F.count("*").alias("n"))
    classes = written(classes.select("sig", F.col("o.doc_id").alias("first_id"), "x.lines", "x.words", "n"), "line-classes")

    held = written(classes.select("sig", "first_id", "lines", "words").mapInArrow(_members(min_words), "sig long, first_id long, line long"), "held-lines")
    rank = F.struct(F.col("first_id").isNull(), "first_id", "sig")
    first = held.groupBy("line").agg(F.min(rank)["sig"].alias("first_sig"), F.count("*").alias("df")).where("df > 1")
    met = written(salted_join(held, first, "line", F.col("sig")).where("sig <> first_sig").select("sig", "line", "first_sig", "df"), "met-lines")

    pairs = written(met.select("sig", "first_sig").distinct(), "line-pairs")
    # The first holder of a very common line meets very many; its lines are then repeated over salts.
    left = salted_join(pairs, classes.select(F.col("sig").alias("first_sig"), F.col("lines").alias("first_lines")), "first_sig", F.col("sig"), hot_rows=20_000)
    both = left.join(classes.select("sig", "lines", "words"), "sig").select("sig", "first_lines", "lines", "words")
    found = written(both.mapInPandas(_aligned(min_words), "sig long, removed binary"), "found")
    # Where there are two holders, the later one has met the other.
    state = met.where("df > 2").groupBy("sig").agg(F.collect_list("line").alias("held")).join(classes.select("sig", "lines", "words"), "sig")
    state = state.join(found.groupBy("sig").agg(F.collect_list("removed").alias("removed")), "sig", "left")
    state = written(state.mapInPandas(_open(min_words), "sig long, line long"), "open-lines")
    if state.take(1):
        size = lambda df, name: df.groupBy("line").agg(F.ceil(F.count("*") / block).cast("int").alias(name))
        holders = held.select("line", "sig").join(state.select("line").distinct(), "line", "left_semi")
        grid = written(size(holders, "n_i").join(size(state, "n_j"), "line"), "open-grid")
        place, every = lambda n: F.pmod(F.xxhash64("sig"), n).cast("int"), lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        old = holders.join(classes.select("sig", "first_id", "lines"), "sig").join(grid, "line").withColumns({"i": place("n_i"), "j": every("n_j")})
        new = state.join(classes.select("sig", "first_id", "lines", "words"), "sig").join(grid, "line").withColumns({"i": every("n_i"), "j": place("n_j")})
        old, new = (x.select(*[F.col(c).alias(c) for c in x.columns if c not in ("n_i", "n_j")]).groupBy("line", "i", "j") for x in (old, new))
        found = found.union(written(old.cogroup(new).applyInPandas(_rest(min_words), "sig long, removed binary"), "found"))
    found = found.groupBy("sig").agg(F.collect_list("removed").alias("removed"))
    return lined, written(classes.select("sig", "first_id", "n").join(found, "sig", "left").where("removed is not null or n > 1"), "removals")


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sig = np.zeros(len(batch), np.int64)
        for i, h, _ in line_hashes(batch.column("_text")):
            sig[i] = signature(h)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sig)], [*batch.schema.names, "_sig"])


def _shortened(texts: list[str | None], lines: Iterator[tuple[int, np.ndarray, np.ndarray]], what) -> tuple[list[str | None], np.ndarray]:  # noqa: ANN001
    """Texts without the lines that what(number of the text, hashes) says, and SIZES of each."""
    kept, size = list(texts), np.zeros((4, len(texts)), np.int64)
    for i, h, w in lines:
        gone = what(i, h)
        if gone.any():
            kept[i] = "\n".join(x for x, g in zip(texts[i].split("\n"), gone, strict=True) if not g)
        size[:, i] = (h != 0).sum(), gone.sum(), w.sum(), w[gone].sum()
    return kept, size


def _finished(rest: pa.Array, kept: list[str | None], size: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([rest, pa.array(kept, pa.string()), *map(pa.array, size)], ["_rest", "_kept", *SIZES])


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is to be deleted stands in the row."""
    for batch in batches:
        ids, firsts, copies, removed = (batch.column(c).to_pylist() for c in ("_id", "_first_id", "_n", "_removed"))

        def what(i: int, h: np.ndarray, ids: list = ids, firsts: list = firsts, copies: list = copies, removed: list = removed) -> np.ndarray:
            if copies[i] is not None and ids[i] != firsts[i]:
                return h != 0  # a later copy
            gone = np.zeros(len(h), bool)
            for part in removed[i] or []:
                gone[np.frombuffer(part, np.int32)] = True
            return gone

        yield _finished(batch.column("_rest"), *_shortened(batch.column("_text").to_pylist(), line_hashes(batch.column("_text")), what))


class Removals:
    """What is to be deleted of each class, as arrays that go to the workers."""

    def __init__(self, rows: pa.Table):
        order = np.argsort(rows["_sig"].to_numpy())
        rows = rows.take(pa.array(order))
        self.sig, self.n = rows["_sig"].to_numpy(), rows["_n"].fill_null(0).to_numpy()
        self.first, self.unnamed = rows["_first_id"].fill_null(0).to_numpy(), rows["_first_id"].is_null().to_numpy()
        parts = [b"".join(x or []) for x in rows["_removed"].to_pylist()]
        self.lines = np.frombuffer(b"".join(parts), np.int32)
        self.cut = np.append(0, np.cumsum([len(x) // 4 for x in parts])).astype(np.int64)

    def __call__(self, doc_id: int | None, h: np.ndarray) -> np.ndarray:
        gone = np.zeros(len(h), bool)
        sig = signature(h)
        k = int(np.searchsorted(self.sig, sig))
        if k == len(self.sig) or self.sig[k] != sig:
            return gone
        first = None if self.unnamed[k] else self.first[k]
        if self.n[k] and doc_id != first:
            return h != 0  # a later copy
        gone[self.lines[self.cut[k] : self.cut[k + 1]]] = True
        return gone


def _delete_known(known: Removals):  # noqa: ANN202
    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id").to_pylist()
            yield _finished(batch.column("_rest"), *_shortened(batch.column("_text").to_pylist(), line_hashes(batch.column("_text")), lambda i, h, ids=ids: known(ids[i], h)))

    return delete


INNER = ("_id", "_text", "_sig", "_first_id", "_n", "_removed")
SIZES = ("n_lines", "removed_lines", "n_words", "removed_words")


def dedup_lines(docs: DataFrame, min_words: int = 5, broadcast_bytes: int = 32 << 20, hot_rows: int = 20_000) -> DataFrame:
    """The rows of docs with the aligned common blocks of earlier documents deleted from text, and n_lines, removed_lines, n_words and
    removed_words (lines without words don't count). Columns of docs with these names are replaced.

    The result is that of alignment with each earlier document. Earlier is of smaller doc_id; null is last. Lines are equal up to outer white space. A block has min_words words or more in all. All
    lines of a later copy (of the same lines) go, however short; rows that repeat the first one's doc_id and lines stay, all
    of them. A null text stays null. An empty table gives an empty result. Sequences of lines are named by 63-bit hashes.
    What is to be deleted goes to the workers where it has at most broadcast_bytes, else it is joined, with hot classes salted.
    """
    start(docs)
    rest = [c for c in docs.columns if c not in ("text", *SIZES)]
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    _, gone = removals(ids, min_words)
    gone = gone.select(F.col("sig").alias("_sig"), F.col("first_id").alias("_first_id"), F.when(F.col("n") > 1, F.col("n")).alias("_n"), F.col("removed").alias("_removed"), "n")
    rows = docs.select(F.struct(*rest).alias("_rest"), F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    kept = StructType([rows.schema["_rest"], StructField("_kept", StringType()), *(StructField(c, LongType()) for c in SIZES)])
    size = gone.agg(F.coalesce(F.sum(48 + F.expr("aggregate(coalesce(_removed, array()), 0, (s, x) -> s + 16 + octet_length(x))")), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        out = rows.mapInArrow(_delete_known(Removals(gone.drop("n").toArrow())), kept)
    else:
        rows = rows.mapInArrow(_signed, StructType([*rows.schema.fields, StructField("_sig", LongType())]))
        apart = -1 - F.pmod(F.xxhash64("_id"), F.lit(1 << 62))  # rows without words meet nothing; they needn't meet each other
        rows = rows.withColumn("_sig", F.when(F.col("_sig") == 0, apart).otherwise(F.col("_sig")))
        counts = gone.select("_sig", F.col("n").alias("count"))
        out = salted_join(rows, gone.drop("n"), "_sig", F.col("_id"), "left", hot_rows, counts).select("_rest", *INNER).mapInArrow(_delete, kept)
    return out.select(*[F.col("_kept").alias("text") if c == "text" else F.col("_rest")[c].alias(c) for c in docs.columns if c not in SIZES], *SIZES)
