"""Walk over Arrow batches that come sorted by some leading columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[pa.Table]:
    """Rows in order of their first ``by`` columns, in tables that hold whole groups only."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(c.to_pylist() for c in batch.columns[:by]), strict=True))
        if held and keys[0] != last:
            yield pa.Table.from_batches(held)
            held = []
        last = keys[-1]
        cut = next((k for k in range(len(keys) - 1, -1, -1) if keys[k] != last), -1) + 1
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def group_edges(table: pa.Table, by: int) -> np.ndarray:
    """First rows of the groups, and the number of rows at the end."""
    keys = np.stack([c.to_numpy() for c in table.columns[:by]], 1)
    return np.append(np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1)))), len(keys))


def text_runs(texts: list[bytes], most: int) -> Iterator[list[bytes]]:
    """Runs of texts with about ``most`` bytes, to be worked on at once."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held
