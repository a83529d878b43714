"""Arrow batches cut to a bounded amount of text."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def pieces(b: pa.RecordBatch, text: int, chars: int = 1_000_000, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Slices of at most `rows` rows and, but for single longer texts, `chars` characters in column `text`."""
    size = pc.fill_null(pc.utf8_length(b.column(text)), 0).to_numpy(zero_copy_only=False)
    at, end = 0, np.cumsum(size)
    while at < len(b):
        stop = int(np.searchsorted(end, (end[at - 1] if at else 0) + chars, side="right"))
        stop = min(max(stop, at + 1), at + rows, len(b))
        yield b.slice(at, stop - at)
        at = stop
