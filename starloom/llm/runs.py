"""Runs of equal keys in sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def runs_of(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of each key, of batches that are sorted by ``keys`` (integers, no
    nulls). Holds the rows of one key, and one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns]) if batch.num_rows > 1 else np.empty(0, bool)
        starts = np.r_[0, np.flatnonzero(new) + 1, batch.num_rows]
        if held and not all(pc.equal(held[0].column(k)[0], batch.column(k)[0]).as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        for at, end in zip(starts[:-1], starts[1:], strict=True):
            held.append(batch.slice(at, end - at))
            if end < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)
