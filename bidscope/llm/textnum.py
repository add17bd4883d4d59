"""Numpy kernels over the UTF-8 buffer of an Arrow string column.

Operators run them inside ``mapInArrow`` tasks. A batch is cut into runs of
documents of about ``CHUNK`` bytes, so working arrays stay at tens of MB
however many rows a batch holds (a single longer text is a run of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20250901).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Words of `[^\x20\x09-\x0D]+`: every byte but the six ASCII white spaces.
SPACE_WORD = np.ones(256, bool)
SPACE_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Words of letters and digits after lower-casing A-Z: 0-9, a-z and every byte of a non-ASCII character.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, _BASE_INV)):
            steps = np.full(max(n, CHUNK + 65536), b, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary array; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, chunk: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Document ranges [lo, hi) of about ``chunk`` bytes each."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + chunk, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def pieces(column: pa.Array, chunk: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, bytes, offsets from 0) for each run of documents of a column."""
    data, offsets = flat(column)
    for lo, hi in runs(offsets, chunk):
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
    # what earlier batches took goes back to the system, as workers live on through all stages
    pa.default_memory_pool().release_unused()


def spans(buf: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal spans of member bytes that do not cross texts: starts, ends, first span of each text (n + 1)."""
    inside = np.zeros(len(buf) + 1, bool)
    inside[:-1] = member[buf]
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(buf))]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    ends_at = inside[:-1] & ~inside[1:]
    ends_at[cuts - 1] = inside[cuts - 1]
    ends = np.flatnonzero(ends_at) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes: a polynomial over a random byte table, from prefix sums."""
    power, inverse = _power(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * power[: len(buf)], dtype=np.uint64, out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k consecutive words within a text, and the first window of each text (n + 1)."""
    counts = np.maximum(np.diff(first) - (k - 1), 0)
    n = max(len(hashes) - (k - 1), 0)
    rolled = np.zeros(n, np.uint64)
    for j in range(k):
        rolled = mix64(rolled * np.uint64(0xD1342543DE82EF95) + hashes[j : n + j])
    owner = np.repeat(np.arange(len(counts)), counts)
    begin = np.concatenate(([0], np.cumsum(counts)))
    at = np.arange(len(owner)) - begin[owner] + first[owner]
    return rolled[at], begin


def chars(buf: np.ndarray) -> np.ndarray:
    """Code points before each byte (n + 1): positions in bytes to positions in code points."""
    out = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=out[1:])
    return out
