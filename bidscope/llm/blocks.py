"""Streaming over groups of rows that a shuffle brought together and sorted."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by it (no null keys); one group is in memory at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and keys[lo] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = keys[lo]
    if held:
        yield pa.Table.from_batches(held)
