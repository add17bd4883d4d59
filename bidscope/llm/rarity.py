"""A token order from rare to frequent, from hashed counts of fixed size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

BITS = 22
_BLOCK = 1 << 16


def summed(rows: DataFrame, length: int, kind: type, put: Callable[[np.ndarray, pa.RecordBatch], None], merge: np.ufunc) -> np.ndarray:
    """One array of ``length`` numbers over all rows: ``put`` enters a batch, ``merge`` unites two arrays.

    Each task enters its rows in one array and sends it in blocks; blocks are merged
    where they meet, so tasks, executors and the driver hold one array, whatever the input.
    """
    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, kind)
        for batch in batches:
            put(total, batch)
        for block in range(-(-length // _BLOCK)):
            part = total[block * _BLOCK : (block + 1) * _BLOCK]
            if part.any():
                yield _row(block, part)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                part = np.frombuffer(zstandard.decompress(packed), kind)
                sums[block] = merge(sums[block], part) if block in sums else part
        for block, part in sums.items():
            yield _row(block, part)

    def _row(block: int, part: np.ndarray) -> pa.RecordBatch:
        packed = zstandard.compress(np.ascontiguousarray(part), 1)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed], pa.binary())], ["block", "counts"])

    schema = "block int, counts binary"
    out = np.zeros(length, kind)
    for r in rows.mapInArrow(enter, schema).repartition("block").mapInArrow(unite, schema).collect():
        out[r.block * _BLOCK : (r.block + 1) * _BLOCK] = np.frombuffer(zstandard.decompress(bytes(r.counts)), kind)
    return out


def hashed_counts(rows: DataFrame, tokens_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int = BITS) -> np.ndarray:
    """Occurrences of tokens in 2**bits buckets (by the low bits of their 64-bit hashes) over all rows.

    A bucket's count is at least each of its tokens'.
    """
    def put(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for tokens in tokens_of(batch):
            np.add.at(total, (tokens & np.uint64((1 << bits) - 1)).astype(np.int64), 1)

    return summed(rows, 1 << bits, np.int64, put, np.add)


def classes(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte each: 0 for none, else about 6 steps a doubling, rounded up."""
    return np.minimum(np.ceil(6 * np.log2(1.0 + counts)), 255).astype(np.uint8)


#: Tokens of this class or a lower one stand in one place of the corpus at most, so no two sets share them.
ONCE = 6


def at_most(class_of: np.ndarray) -> np.ndarray:
    """The largest count that a class stands for."""
    return np.exp2(class_of.astype(np.float64) / 6)
