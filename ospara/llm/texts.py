"""Text columns inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

#: A-Z to a-z, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes of text that a task unpacks at a time.
SLICE_BYTES = 16 << 20


def raw(column) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    return [b or b"" for b in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = batch.column(column).cast(pa.large_binary())
        sizes = np.asarray(pc.fill_null(pc.binary_length(lengths), 0))
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start] - sizes[start]
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def task_number() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0
