"""Arrow batches in parts: what a worker holds does not depend on how long the texts of a batch are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of text, or tokens, that are worked on at once.
CHARACTERS, TOKENS = 1 << 20, 1 << 19


def parts(rows: pa.Array, sizes: pa.Array, most: int) -> Iterator[pa.Array]:
    """rows in runs whose sizes add up to at most `most`; a larger row is a run of its own."""
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield rows.slice(at, to - at)
        at = to


def texts(column: pa.Array, most: int = CHARACTERS) -> Iterator[pa.Array]:
    return parts(column, pc.binary_length(column), most)
