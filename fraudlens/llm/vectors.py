"""Vector columns as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and a matrix for each length of usable vectors: not null, not empty, all finite."""
    if not len(column):
        return
    flat, sizes = column.flatten(), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.fill_null(0).to_numpy(zero_copy_only=False)
    heads = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        at = heads[rows][:, None] + np.arange(size)
        matrix = values[at]
        good = ~empty[at].any(1) & np.isfinite(matrix).all(1)
        yield rows[good], matrix[good]


def cells(rows: np.ndarray, matrix: np.ndarray, n: int) -> list[bytes | None]:
    """The bytes of each row's vector, at its row number."""
    out: list[bytes | None] = [None] * n
    kept = np.ascontiguousarray(matrix)
    for r, v in zip(rows.tolist(), kept, strict=True):
        out[r] = v.tobytes()
    return out
