"""Arrow batches cut so that Python never holds more than a bounded amount of text or numbers at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _cut(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows or not batch.num_rows:
        yield batch.slice(start)


def by_text(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices whose texts have ``most`` bytes together, or one row of more."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    return _cut(batch, sizes + 64, most)


def by_items(batch: pa.RecordBatch, column: int, most: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Slices whose lists have ``most`` items together, or one row of more."""
    sizes = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    return _cut(batch, sizes + 1, most)
