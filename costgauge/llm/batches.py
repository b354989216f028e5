"""Arrow batches cut to a size that several Python workers can hold next to an executor's heap."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 2 << 20


def _c_library() -> ctypes.CDLL | None:
    library = ctypes.CDLL(None)
    return library if hasattr(library, "malloc_trim") else None


_libc = _c_library()


def give_back() -> None:
    """Return freed memory to the system; several workers share an executor's."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def ranges(column: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `size` bytes (items, if the column has lists) each; a row is never cut."""
    length = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    sizes = pc.fill_null(length(column), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // size
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(column)]
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b > a:
            yield a, b


def pieces(batches: Iterator[pa.RecordBatch], at: int, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Batches cut to about `size` bytes (or items) of one column."""
    for batch in batches:
        for a, b in ranges(batch.column(at), size):
            yield batch.slice(a, b - a)
            give_back()
