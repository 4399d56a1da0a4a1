"""Arrow batches in slices of bounded size: what a Python worker turns into its own objects at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Most rows of a slice, and most bytes of its values: strings grow about tenfold as Python objects.
ROWS, BYTES = 1_024, 4 << 20


def sizes(values: pa.Array) -> np.ndarray:
    """About how many bytes each row has; a list counts its items, of strings by their mean length."""
    kind = values.type
    if pa.types.is_struct(kind):
        return sum((sizes(v) for v in values.flatten()), np.zeros(len(values)))
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(float)
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        items = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(float)
        inner = sizes(values.flatten())
        return items * (8 + (inner.mean() if len(inner) else 0))
    return np.full(len(values), 8.0)


def cuts(size: np.ndarray, rows: int = ROWS, most: int = BYTES) -> Iterator[tuple[int, int]]:
    """(first, length) of the slices; a row larger than ``most`` is a slice of its own."""
    ends = np.cumsum(size)
    first = 0
    while first < len(size):
        before = ends[first - 1] if first else 0.0
        last = int(np.searchsorted(ends, before + most, side="right"))
        last = min(max(last, first + 1), first + rows)
        yield first, last - first
        first = last


def of_array(values: pa.Array, rows: int = ROWS, most: int = BYTES) -> Iterator[pa.Array]:
    for first, n in cuts(sizes(values), rows, most):
        yield values.slice(first, n)


def of_batch(batch: pa.RecordBatch, rows: int = ROWS, most: int = BYTES) -> Iterator[pa.RecordBatch]:
    size = sum((sizes(c) for c in batch.columns), np.zeros(batch.num_rows))
    for first, n in cuts(size, rows, most):
        yield batch.slice(first, n)
