"""Arrow list columns as numpy vectors, shared by the embedding operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def finite_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat doubles, start of each row in them, length of each row). A row that
    is null or holds a null or non-finite entry has length -1, an empty one 0."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    unusable = (bad[ends] != bad[starts]) | column.is_null().to_numpy(zero_copy_only=False)
    return flat, starts, np.where(unusable, -1, lengths)


def stacked(blobs: pa.Array, kind: str) -> np.ndarray:
    """Equally long binaries as the rows of one matrix."""
    return np.frombuffer(b"".join(blobs.to_pylist()), kind).reshape(len(blobs), -1)
