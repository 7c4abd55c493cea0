"""Arrays of fixed size that every task fills and that are added up in slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICES = 256
_KIND = "slice int, sums binary"


def _row(slice_: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([slice_], pa.int32()), pa.array([sums.astype("<f8").tobytes()], pa.binary())], names=["slice", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slices of one partition added up as they arrive; no more than one sum of each is held."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch.column(0).to_pylist(), batch.column(1)):
            sums = np.frombuffer(part.as_buffer(), "<f8")
            held[k] = held[k] + sums if k in held else sums
    for k, sums in held.items():
        yield _row(k, sums)


def total_array(rows: DataFrame, fill: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """Sum over all tasks of the ``size`` numbers that ``fill`` returns for the rows of one task.

    ``size`` doesn't depend on the data, nor does what reaches the driver or is held by a task.
    Tasks send the slices of their arrays that aren't all zero; a slice is added up as it
    streams through the task that it was sent to, however many tasks there are.
    """
    slices = min(SLICES, max(1, size // 512))
    width = -(-size // slices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        padded = np.zeros(width * slices)
        padded[:size] = fill(batches)
        for k, part in enumerate(np.split(padded, slices)):
            if part.any():
                yield _row(k, part)

    out = np.zeros(width * slices)
    for r in rows.mapInArrow(run, _KIND).repartition("slice").mapInArrow(_added, _KIND).collect():
        out[r["slice"] * width :][:width] += np.frombuffer(r["sums"], "<f8")
    return out[:size]
