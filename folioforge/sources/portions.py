"""Arrow batches in slices that Python can hold a few copies of."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc


def portions(batch: pa.RecordBatch, rows: int = 1000, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most `rows` rows and about `size` bytes of strings, one row at least: a batch of Spark's holds ten thousand whole texts, and Python's copies of them and of the answers would stand beside each other."""
    lengths = [pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False) for c in batch.columns if pa.types.is_string(c.type) or pa.types.is_binary(c.type)]
    sums = sum(lengths).cumsum() if lengths else None
    at, n = 0, batch.num_rows
    while at < n:
        end = min(at + rows, n)
        if sums is not None:
            end = min(end, max(at + 1, int(sums.searchsorted((sums[at - 1] if at else 0) + size, "right"))))
        yield batch.slice(at, end - at)
        at = end
