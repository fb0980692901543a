"""Words of whole Arrow batches as numpy arrays: no Python object for a word or a character.

A word is a run of bytes other than space and \\t to \\r, which for UTF-8 is the same as a run of such characters.
Hashes are 64 bits of a polynomial over random byte values, mixed afterwards.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that begin a code point.
LEAD = (np.arange(256) & 0xC0) != 0x80
#: Bytes hashed at once; temporaries take about 40 times as much.
CHUNK = 1 << 18

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None


def trim() -> None:
    """Give freed memory back to the system: workers live on after a task, beside others in the same container."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


_rng = np.random.default_rng(20240229)
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
_BASE = U(0x9E3779B97F4A7C15) | U(1)
_INVERSE = U(pow(int(_BASE), -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, CHUNK + 1), _powers(_INVERSE, CHUNK + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; spans are ascending and don't overlap. Memory stays near 40 x CHUNK bytes."""
    out = np.empty(len(start), U)
    i, n = 0, len(start)
    while i < n:
        lo = start[i]
        j = int(np.searchsorted(end, lo + CHUNK, "right"))
        if j <= i:  # one span longer than a chunk: Horner's rule over chunks
            total, shift = 0, 1
            for a in range(int(lo), int(end[i]), CHUNK):
                part = _VALUES[buf[a : min(a + CHUNK, int(end[i]))]]
                total += int((part * _UP[: len(part)]).sum(dtype=U)) * shift
                shift = shift * int(_UP[CHUNK]) % 2**64
            out[i] = total % 2**64
            i += 1
            continue
        hi = end[j - 1]
        sums = np.zeros(int(hi - lo) + 1, U)
        np.cumsum(_VALUES[buf[lo:hi]] * _UP[: int(hi - lo)], out=sums[1:])
        a, b = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (sums[b] - sums[a]) * _DOWN[a]
        i = j
    out += (end - start).astype(U) * U(0xD6E8FEB86659FD93)
    return mix(out)


@dataclass
class Block:
    """Some texts: their bytes, and their words as byte positions; text i has the words cut[i] to cut[i + 1]."""

    first: int
    buf: np.ndarray
    off: np.ndarray
    start: np.ndarray
    end: np.ndarray
    cut: np.ndarray

    @property
    def n(self) -> int:
        return len(self.off) - 1

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.start, self.end)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.cut))

    def per_doc(self, flags: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
        """Sum of flags (one for each byte, or with bounds=cut for each word) in each text."""
        bounds = self.off if bounds is None else bounds
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[bounds[1:]] - sums[bounds[:-1]]


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its values; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def text_of(rows: pa.Array) -> pa.Array:
    """The column text of an array of structs."""
    return pc.struct_field(rows, "text")


def split_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte positions where words start and end, and the number of the first word of each text."""
    size = len(buf)
    inside = np.zeros(size + 2, bool)
    np.logical_not(SPACE[buf], out=inside[1:-1])
    begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edge = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < size)]
    begins[edge] = inside[edge + 1]
    ends[edge - 1] = inside[edge]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, off)


def blocks(column: pa.Array, lower: bool = False, most: int = 4 * CHUNK) -> Iterator[Block]:
    """The texts of a column in blocks of about `most` bytes; a longer text is a block by itself."""
    buf, off = raw(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        b, o = buf[off[i] : off[j]], off[i : j + 1] - off[i]
        if lower:
            b = LOWER[b]
        yield Block(i, b, o, *split_words(b, o))
        i = j
    trim()


def grams(h: np.ndarray, cut: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n words from each word on, and whether they all lie in its text."""
    size = len(h)
    out = np.zeros(size, U)
    valid = np.zeros(size, bool)
    if size >= n:
        for k in range(n):
            out[: size - n + 1] = out[: size - n + 1] * U(0x2545F4914F6CDD1D) + h[k : size - n + 1 + k]
        valid[: size - n + 1] = True
        valid &= np.arange(size) + n <= np.repeat(cut[1:], np.diff(cut))
    return mix(out), valid
