"""Arrow list columns as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def by_length(arr: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, float64 matrix) for every length among the lists of ``arr``.

    Null lists and empty lists are left out; null entries become NaN.
    """
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not len(arr) or pa.types.is_null(arr.type):
        return
    n = np.asarray(arr.value_lengths().fill_null(0), dtype=np.int64)
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.cumsum(n) - n
    for dim in np.unique(n[n > 0]).tolist():
        rows = np.flatnonzero(n == dim)
        yield rows, flat[first[rows][:, None] + np.arange(dim)]
