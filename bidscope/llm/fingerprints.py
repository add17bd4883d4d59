"""Document fingerprints by locally consistent parsing.

A text is parsed bottom-up into named phrases, starting from its bytes. On each
level

1. a run of one symbol becomes a symbol of its own (named by symbol and length),
   so neighbours differ;
2. deterministic coin tossing colours every symbol: the lowest bit in which it
   differs from its left neighbour, and that bit's value; four rounds bring 64-bit
   names down to at most six colours, still different from the neighbour's;
3. a phrase begins at each local maximum of the colours and is named by a hash of
   its symbols, which are the next level's symbols.

Where a phrase begins depends on a few symbols around it only, so equal substrings
get the same names inside wherever they stand. The fingerprint is a one-permutation
min-hash sketch (``SLOTS`` slots of 16 bits, in hex) of the names of levels
``LEVELS``; likeness is the share of the occupied slots that agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textnum as tn
from .scratch import ship

SLOTS = 64
LEVELS = (3, 4, 5)
EMPTY = 0xFFFF
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

_SYMBOL = tn.mix64(np.arange(1, 257, dtype=np.uint64))
_BIT_AT = np.zeros(64, np.uint8)
_DE_BRUIJN = np.uint64(0x03F79D71B4CB0A89)
with np.errstate(over="ignore"):
    _BIT_AT[((np.uint64(1) << np.arange(64, dtype=np.uint64)) * _DE_BRUIJN) >> np.uint64(58)] = np.arange(64)


def _toss(width: int) -> np.ndarray:
    """Colour of (left, own) for all pairs of small colours."""
    left, own = np.meshgrid(np.arange(width), np.arange(width), indexing="ij")
    low = (left ^ own) & -(left ^ own)
    at = np.zeros_like(low)
    for b in range(width.bit_length()):
        at[low == 1 << b] = b
    return (2 * at + (own >> at & 1)).astype(np.uint8).ravel()


_ROUNDS = ((128, _toss(128)), (16, _toss(16)), (8, _toss(8)))


def _squeeze(names: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol as one symbol; ``head`` marks the first symbol of each text."""
    begins = head.copy()
    begins[1:] |= names[1:] != names[:-1]
    if begins.all():
        return names, head
    at = np.flatnonzero(begins)
    length = np.diff(at, append=len(names)).astype(np.uint64)
    kept = names[at]
    long = length > 1
    kept[long] = tn.mix64(kept[long] + length[long] * np.uint64(0x9E3779B97F4A7C15))
    return kept, head[at]


def _landmarks(names: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Where phrases begin: the first symbol of each text and every local maximum of the tossed colours."""
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[head] = ~names[head]
    differ = names ^ left
    low = differ & (~differ + np.uint64(1))
    at = _BIT_AT[(low * _DE_BRUIJN) >> np.uint64(58)]
    colour = 2 * at + ((names & low) != 0)
    for width, table in _ROUNDS:
        before = np.empty_like(colour)
        before[1:] = colour[:-1]
        before[head] = colour[head] ^ 1
        colour = table[before.astype(np.uint16) * np.uint16(width) + colour]
    begins = head.copy()
    # A text's last symbol has no right neighbour, so it begins no phrase.
    inner = (colour[1:-1] > colour[:-2]) & (colour[1:-1] > colour[2:]) & ~head[2:]
    begins[1:-1] |= inner
    return np.flatnonzero(begins)


def _names(symbols: np.ndarray, begins: np.ndarray, level: int) -> np.ndarray:
    """A hash of each phrase's symbols, by polynomial prefix sums."""
    ends = np.append(begins[1:], len(symbols))
    power, inverse = tn._power(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * power[: len(symbols)], dtype=np.uint64, out=sums[1:])
    return tn.mix64((sums[ends] - sums[begins]) * inverse[begins] + (ends - begins).astype(np.uint64) + np.uint64(level << 32))


def sketch(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``SLOTS`` minima for each text (EMPTY: no phrase in the slot)."""
    n = len(offsets) - 1
    out = np.full(n * SLOTS, EMPTY, np.uint16)
    lengths = np.diff(offsets)
    texts = np.flatnonzero(lengths > 0)
    if not len(texts):
        return out.reshape(n, SLOTS)
    names = _SYMBOL[buf]
    head = np.zeros(len(buf), bool)
    head[offsets[texts]] = True
    found = []
    for level in range(1, LEVELS[-1] + 1):
        names, head = _squeeze(names, head)
        begins = _landmarks(names, head)
        names, head = _names(names, begins, level), head[begins]
        if level in LEVELS:
            owner = texts[np.cumsum(head) - 1].astype(np.uint64)
            slot = owner * np.uint64(SLOTS) + (names >> np.uint64(58))
            value = np.minimum((names >> np.uint64(8)) & np.uint64(0xFFFF), np.uint64(EMPTY - 1))
            found.append(slot << np.uint64(16) | value)
    found = np.sort(np.concatenate(found))
    slots, at = np.unique(found >> np.uint64(16), return_index=True)
    out[slots] = (found[at] & np.uint64(0xFFFF)).astype(np.uint16)
    return out.reshape(n, SLOTS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of the slots occupied in either sketch that agree; 1 for two sketches without phrases."""
    used = ((a != EMPTY) | (b != EMPTY)).sum(axis=-1)
    agree = ((a == b) & (a != EMPTY)).sum(axis=-1)
    return np.where(used > 0, agree / np.maximum(used, 1), 1.0)


def _hex(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows.astype(">u2")]


def _sketches(texts: list[bytes]) -> np.ndarray:
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    return sketch(np.frombuffer(b"".join(texts), np.uint8), offsets)


def _finish(rows: list[tuple]) -> pa.RecordBatch:
    """Results of consecutive rows (doc_id, text, next text or None)."""
    own = [t.encode() for _, t, _ in rows]
    edited, chars, nexts = [], [], []
    for _, text, after in rows:
        half = len(text) // 2
        edited.append((text[: len(text) - half] + (after or "")[:half]).encode())
        chars.append(len(text))
        nexts.append((after or "").encode())
    a, b, c = _sketches(own), _sketches(edited), np.empty((len(rows), SLOTS), np.uint16)
    # A successor is mostly the next row, whose sketch is there already.
    c[:-1] = a[1:]
    odd = [i for i in range(len(rows)) if i + 1 == len(rows) or rows[i][2] is not rows[i + 1][1]]
    if odd:
        c[odd] = _sketches([nexts[i] for i in odd])
    near_next = likeness(a, c)
    near_next[[i for i, r in enumerate(rows) if r[2] is None]] = 0.0
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()), pa.array(chars, pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            pa.array(_hex(a), pa.string()), pa.array(_hex(b), pa.string()),
            pa.array(likeness(a, b), pa.float64()), pa.array(near_next, pa.float64()),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, text, text of the next document) of rows sorted by part, guest, doc_id, text."""
    held = None
    for batch in batches:
        for part, guest, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text")]):
            text = text or ""
            if held is not None:
                yield held[1], held[2], text if held[0] == part else None
            held = None
            if doc_id is None:
                yield None, text, None
            elif not guest:
                held = (part, doc_id, text)
    if held is not None:
        yield held[1], held[2], None


def in_order(docs: DataFrame) -> DataFrame:
    """part, guest, doc_id, text in contiguous ranges of doc_id, each range followed by its successor as a guest.

    The ranges come from approximate quantiles of doc_id: as many numbers as there
    are shuffle partitions, and as many first rows, so both are of fixed size.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 100 * parts).alias("q")).first().q if shares else []
    cuts = sorted(set(cuts or []))
    at = F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    placed = docs.withColumn("part", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(parts))).otherwise(at).cast("int"))
    firsts = placed.filter("doc_id is not null").groupBy("part").agg(F.min("doc_id").alias("first_id"))
    order = Window.partitionBy(F.lit(0)).orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select("first_id", F.coalesce(F.lag("part").over(order), F.max("part").over(whole)).alias("before"))
    here = F.array(F.struct(F.col("part"), F.lit(0).alias("guest")))
    also = F.array(F.struct(F.col("before").alias("part"), F.lit(1).alias("guest")))
    rows = placed.join(F.broadcast(firsts), placed.doc_id == firsts.first_id, "left").select(
        "doc_id", "text", F.explode(F.when(F.col("before").isNull(), here).otherwise(F.concat(here, also))).alias("p")
    )
    return rows.select("p.part", "p.guest", "doc_id", "text").repartitionById(parts, F.col("part")).sortWithinPartitions("part", "guest", "doc_id", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row's whole text and of its edited text, and how alike they and the next one are.

    The edited text's last floor(n / 2) code points are the first as many (or all)
    of the next document's, ascending doc_id, the first after the last. Null or
    empty text: no phrases; two such texts are alike (1), one and any other are not
    (0). Rows of one doc_id follow each other by text. A row with a null doc_id has
    no place in the order: nothing replaces its last half, near_next is 0. An empty
    table gives an empty result; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in _with_next(batches):
            rows.append(row)
            size += len(row[1])
            if size > tn.CHUNK:
                yield _finish(rows)
                rows, size = [], 0
        if rows:
            yield _finish(rows)

    ship(docs.sparkSession)
    return in_order(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")).mapInArrow(run, SCHEMA)
