"""Set-similarity join by prefix postings, for families of similar sets too.

``postings`` are rows (token, cell, side, id, n, pos): the set ``id`` of n tokens has the
token at position ``pos`` of its prefix; ids are numbers in the order of the sets. Sets
that share a posting list and pass the length and positional filters are candidates.
Two columns s0, s1 may hold a parity signature of the set (each token flips one bit):
signatures differ in no more bits than the sets in tokens, so pairs that differ in
more bits than the similarity allows are no candidates.

Pairs within a family of similar sets are not all listed. ``first_candidates`` gives
each set its earliest ``tries`` candidates of each list and passes on the lists where
it held any back. After these are verified, ``open_candidates`` goes through the lists
passed on and gives every candidate pair whose outcome is still open; for components,
``across_candidates`` gives each set its earliest few in each other component, and passes on
in turn, until no list holds anything back. Nothing that could matter is dropped, so
the rounds together are exact.

A list of a frequent token is dealt over cells: its sets are split in groups, and each
pair of groups meets in one cell (``deal``), so a cell has at most about 2 ``CELL`` sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn

CELL = 20_000
POSTING = "token int, cell int, side int, id long, n int, pos int"
SIGNED = f"{POSTING}, s0 long, s1 long"
_KINDS = {"int": pa.int32(), "long": pa.int64()}
_YIELD = 100_000
#: Rows of whole lists that are gone through together.
_TOGETHER = 100_000


def fields(schema: str) -> list[tuple[str, pa.DataType]]:
    return [(f.split()[0], _KINDS[f.split()[1]]) for f in schema.split(", ")]


def rows(schema: str, values) -> pa.RecordBatch:
    """A batch of these columns."""
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(values, fields(schema))], [n for n, _ in fields(schema)])


def needed(t: Fraction, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Smallest intersection of two sets of these sizes with Jaccard similarity t or more."""
    return -((-t.numerator * (na + nb)) // (t.numerator + t.denominator))


def prefix_length(t: Fraction, n: np.ndarray) -> np.ndarray:
    """So many first tokens of any global order must share one with each similar set's."""
    return n - -((-t.numerator * n) // t.denominator) + 1


def deal(token: np.ndarray, ids: np.ndarray, bound: np.ndarray, size: int = CELL) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each posting its cells: (index of the posting, cell, side). ``bound``: at most so many sets have the token."""
    groups = np.minimum(np.maximum(np.ceil(bound / size), 1), 1 << 15).astype(np.int64)
    at = np.repeat(np.arange(len(token)), groups)
    begin = np.concatenate(([0], np.cumsum(groups)[:-1]))
    other = np.arange(len(at)) - begin[at]
    own = (tn.mix64(ids.astype(np.uint64)) % groups.astype(np.uint64)).astype(np.int64)[at]
    cell = np.minimum(own, other) << 15 | np.maximum(own, other)
    return at, cell.astype(np.int32), np.where(own == other, -1, own).astype(np.int32)


def parity(token: np.ndarray, begin: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity signatures of the sets token[begin[i]:begin[i + 1]]: bytes of all, and the first byte of each (n + 1).

    ``bits``: a power of two of 8 or more for each set; wider signatures fold to
    narrower ones by xor of their halves.
    """
    owner = np.repeat(np.arange(len(bits)), np.diff(begin))
    start = np.concatenate(([0], np.cumsum(bits)))
    at = start[owner] + (tn.mix64(token ^ np.uint64(0x3C3C)) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(at, minlength=start[-1]) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little"), start // 8


def differing_most(t: Fraction, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Tokens in one of two similar sets of these sizes only: at most so many."""
    return na + nb - 2 * needed(t, na, nb)


def fold(signatures: list[bytes]) -> np.ndarray:
    """Signatures as rows of 64-bit words, all folded to the narrowest one's width."""
    width = min(map(len, signatures))
    out = np.empty((len(signatures), width // 8), np.uint64)
    for i, s in enumerate(signatures):
        words = np.frombuffer(s, np.uint64)
        out[i] = np.bitwise_xor.reduce(words.reshape(-1, width // 8), axis=0)
    return out


def _lists(postings: DataFrame, schema: str, *more: str) -> DataFrame:
    """Postings dealt by list, the rows of each list together; a list is one number, as are n and pos with the side (1: the cell's larger group)."""
    side = (F.col("side") == F.col("cell").bitwiseAND(32767)).cast("long")
    packed = [
        (F.shiftleft(F.col("token").cast("long"), 32) + F.col("cell")).alias("list"), "id",
        (F.shiftleft(F.col("n").cast("long"), 32) + F.shiftleft(F.col("pos").cast("long"), 1) + side).alias("size"),
    ]
    signed = [n for n, _ in fields(schema) if n in ("s0", "s1")]
    return postings.select(*packed, *signed, *more).repartition("list").sortWithinPartitions("list")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_lists`` with the columns of postings."""
    for batch in batches:
        of_list, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("list", "size"))
        cell = of_list & 0x3FFFFFFF
        low, high = cell >> 15, cell & 32767
        side = np.where(low == high, -1, np.where(size & 1 == 1, high, low))
        posting = [of_list >> 32, cell, side, size >> 32, (size & 0xFFFFFFFF) >> 1]
        rest = [c for c in batch.schema.names if c not in ("list", "size")]
        yield pa.RecordBatch.from_arrays([*[pa.array(v.astype(np.int32)) for v in posting], *[batch.column(c) for c in rest]], ["token", "cell", "side", "n", "pos", *rest])


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Columns of whole lists, each in order of id, and the first row of each (and the end), from sorted batches."""
    held: dict[str, np.ndarray] | None = None
    waiting: list[dict[str, np.ndarray]] = []

    def cut(cols: dict[str, np.ndarray]) -> np.ndarray:
        new = (cols["token"][1:] != cols["token"][:-1]) | (cols["cell"][1:] != cols["cell"][:-1])
        return np.concatenate(([0], np.flatnonzero(new) + 1))

    def by_id(cols: dict[str, np.ndarray], begins: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        order = np.lexsort((cols["id"], np.repeat(np.arange(len(begins) - 1), np.diff(begins))))
        return {c: v[order] for c, v in cols.items()}, begins

    def read() -> Iterator[dict[str, np.ndarray]]:
        size = 0
        for batch in batches:
            waiting.append({c: batch.column(c).to_numpy(zero_copy_only=False) for c in names})
            size += batch.num_rows
            if size >= _TOGETHER:
                yield joined()
                size = 0
        if size:
            yield joined()

    def joined() -> dict[str, np.ndarray]:
        parts = ([held] if held is not None else []) + waiting
        out = {c: np.concatenate([x[c] for x in parts]) for c in names}
        waiting.clear()
        return out

    for cols in read():
        begins = cut(cols)
        held = {c: v[begins[-1] :] for c, v in cols.items()}
        if begins[-1]:
            yield by_id({c: v[: begins[-1]] for c, v in cols.items()}, begins)
    if held is not None and len(held["token"]):
        yield by_id(held, np.append(cut(held), len(held["token"])))


def _passes(c: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, t: Fraction) -> np.ndarray:
    """Length, positional, signature and side filters of row pairs; a set whose tokens share bits may stand twice in a list and does not meet itself.

    A similar pair meets in the list of its first shared token, of which all the
    intersection's other tokens come after: so the positional bound may count from here.
    """
    na, nb = c["n"][a].astype(np.int64), c["n"][b].astype(np.int64)
    ok = t.denominator * np.minimum(na, nb) >= t.numerator * np.maximum(na, nb)
    # The other filters look at the pairs that are left only.
    left = np.flatnonzero(ok)
    a, b, na, nb = a[left], b[left], na[left], nb[left]
    fine = np.minimum(na - c["pos"][a], nb - c["pos"][b]) >= needed(t, na, nb)
    side = c["side"][a]
    fine &= (side != c["side"][b]) | (side < 0)
    fine &= c["id"][a] != c["id"][b]
    if "s0" in c:
        # As unsigned words: the bits of a negative number are counted of its absolute value.
        apart = sum(np.bitwise_count((c[s][a] ^ c[s][b]).view(np.uint64)).astype(np.int64) for s in ("s0", "s1"))
        fine &= apart <= differing_most(t, na, nb)
    ok[left] = fine
    return ok


def first_candidates(postings: DataFrame, t: Fraction, schema: str, tries: int = 3) -> DataFrame:
    """Rows (a, b): each set's earliest candidates; rows with a null: postings of the lists that held candidates back."""
    names = [n for n, _ in fields(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, begins in _groups(_unpacked(batches), names):
            size = np.diff(begins)
            first = np.repeat(begins[:-1], size)
            place = np.arange(len(first)) - first
            left = np.full(len(first), tries)
            active = np.flatnonzero(place > 0)
            more = np.zeros(len(first), bool)
            out_a, out_b, step = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
            while len(active):
                a = first[active] + step
                ok = _passes(c, a, active, t)
                spent = left[active] == 0
                more[active[ok & spent]] = True
                hit = ok & ~spent
                out_a.append(c["id"][a[hit]])
                out_b.append(c["id"][active[hit]])
                left[active[hit]] -= 1
                step += 1
                active = active[(place[active] > step) & ~more[active]]
            pairs = np.unique(np.stack((np.concatenate(out_a), np.concatenate(out_b)), axis=1), axis=0)
            kept = np.flatnonzero(np.repeat(np.logical_or.reduceat(more, begins[:-1]), size))
            m, k = len(pairs), len(kept)
            none = np.arange(m + k) >= m
            ends = [pa.array(np.concatenate((x, np.zeros(k, np.int64))), pa.int64(), mask=none) for x in (pairs[:, 0], pairs[:, 1])]
            held = [pa.array(np.concatenate((np.zeros(m, c[n].dtype), c[n][kept])), kind, mask=~none) for n, kind in fields(schema)]
            yield pa.RecordBatch.from_arrays([*ends, *held], ["a", "b", *names])

    return _lists(postings, schema).mapInArrow(run, f"a long, b long, {schema}")


def open_candidates(postings: DataFrame, t: Fraction, schema: str) -> DataFrame:
    """All candidate pairs (a, b) of the lists that are still open, by the postings' column ``tag``: 0 for a set
    without an earlier match yet, whose pairs with earlier sets are open."""
    names = [n for n, _ in fields(schema)] + ["tag"]

    def within(c: dict[str, np.ndarray], rows_: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for r in rows_[c["tag"][rows_] == 0].tolist():
            others = rows_[: r - rows_[0]]
            others = others[_passes(c, others, np.full(len(others), r), t)]
            if len(others):
                yield np.minimum(c["id"][others], c["id"][r]), np.maximum(c["id"][others], c["id"][r])

    def batch(out: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        pairs = np.unique(np.concatenate([np.stack(x, axis=1) for x in out]), axis=0)
        return rows("a long, b long", (pairs[:, 0], pairs[:, 1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for c, begins in _groups(_unpacked(batches), names):
            for g in np.flatnonzero(np.add.reduceat(c["tag"] == 0, begins[:-1]) > 0).tolist():
                for found in within(c, np.arange(begins[g], begins[g + 1])):
                    out.append(found)
                    size += len(found[0])
                    if size >= _YIELD:
                        yield batch(out)
                        out, size = [], 0
        if out:
            yield batch(out)

    return _lists(postings, schema, "tag").mapInArrow(run, "a long, b long")


def across_candidates(postings: DataFrame, t: Fraction, schema: str, tries: int) -> DataFrame:
    """Rows (a, b): candidates in different components, of each set and other component the earliest ``tries`` of a
    list; rows with a null: postings of the lists that held candidates back.

    ``postings`` have a column ``tag``, the set's component, and ``parity``, its parity signature. One link unites two
    components, so a set rarely needs more than a few tries with each, and pairs stay in proportion to
    the postings; what no try has linked comes again with more of them.
    """
    names = [n for n, _ in fields(schema)]

    def within(c: dict[str, np.ndarray], rows_: np.ndarray) -> tuple[list[np.ndarray], bool]:
        tag, n, ids = c["tag"], c["n"].astype(np.int64), c["id"]
        values, count = np.unique(tag[rows_], return_counts=True)
        signs = fold([c["parity"][i] for i in rows_.tolist()])
        pairs, more = [], False
        # pairs within the largest component are settled, so all others have a set outside it
        for r in rows_[tag[rows_] != values[count.argmax()]].tolist():
            others = rows_[tag[rows_] != tag[r]]
            others = others[_passes(c, others, np.full(len(others), r), t)]
            bits = np.bitwise_count(signs[others - rows_[0]] ^ signs[r - rows_[0]]).sum(axis=1, dtype=np.int64)
            others = others[bits <= differing_most(t, n[others], np.full(len(others), n[r]))]
            if not len(others):
                continue
            # rank of each candidate among those of its component, in order of id
            order = np.argsort(tag[others], kind="stable")
            of = tag[others][order]
            start = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            rank = np.arange(len(of)) - np.repeat(start, np.diff(np.append(start, len(of))))
            more |= bool((rank >= tries).any())
            near = others[order][rank < tries]
            pairs.append(np.stack((np.minimum(ids[near], ids[r]), np.maximum(ids[near], ids[r])), axis=1))
        return pairs, more

    def batch(c: dict[str, np.ndarray], pairs: list[np.ndarray], kept: list[np.ndarray]) -> pa.RecordBatch:
        found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.empty((0, 2), np.int64)
        rest = np.concatenate(kept) if kept else np.empty(0, np.int64)
        m, k = len(found), len(rest)
        none = np.arange(m + k) >= m
        ends = [pa.array(np.concatenate((x, np.zeros(k, np.int64))), pa.int64(), mask=none) for x in (found[:, 0], found[:, 1])]
        held = [pa.array(np.concatenate((np.zeros(m, c[x].dtype), c[x][rest])), kind, mask=~none) for x, kind in fields(schema)]
        return pa.RecordBatch.from_arrays([*ends, *held], ["a", "b", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, begins in _groups(_unpacked(batches), [*names, "tag", "parity"]):
            several = np.minimum.reduceat(c["tag"], begins[:-1]) != np.maximum.reduceat(c["tag"], begins[:-1])
            pairs, kept = [], []
            for g in np.flatnonzero(several).tolist():
                rows_ = np.arange(begins[g], begins[g + 1])
                found, more = within(c, rows_)
                pairs += found
                if more:
                    kept.append(rows_)
            if pairs:
                yield batch(c, pairs, kept)

    return _lists(postings, schema, "tag", "parity").mapInArrow(run, f"a long, b long, {schema}")


def compare(pairs: DataFrame, payloads: DataFrame, verdict: Callable[[object, object], bool], prepare: Callable[[object], object]) -> DataFrame:
    """Pairs (a, b) that ``verdict`` confirms on the prepared payloads of both; payloads: (id, payload), one row an id.

    A pair fetches its payloads by two joins and is judged where the second one leaves it, so
    pairs move twice. The last join sorts by a, whose payload is prepared once for its
    neighbouring pairs; a hub of many pairs is a skewed join key, which Spark splits.
    """
    # Payloads are joined by shuffle whatever Spark guesses of their size.
    payloads = payloads.select("id", "payload").hint("merge")
    rows = pairs.select("a", "b").join(payloads.toDF("b", "right"), "b").join(payloads.toDF("a", "left"), "a").select("a", "b", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, None
        for batch in batches:
            out_a, out_b = [], []
            left, right = batch.column("left"), batch.column("right")
            for i, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                if a != hub:
                    hub, own = a, prepare(left[i].as_py())
                if verdict(own, prepare(right[i].as_py())):
                    out_a.append(a)
                    out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


#: Bits of a block of a bit field: those of Spark's bitmap functions.
_FIELD_BLOCK = 15


def members(keys: DataFrame, bits: int = 24) -> np.ndarray:
    """A bit field of fixed size with the hashes of one long column: rows that it lacks need not be read further."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = tn.mix64(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array((hashes & np.uint64((1 << bits) - 1)).astype(np.int64))], ["at"])

    within = F.col("at").bitwiseAND((1 << _FIELD_BLOCK) - 1)
    blocks = keys.mapInArrow(places, "at long").groupBy(F.shiftright("at", _FIELD_BLOCK).alias("block")).agg(F.bitmap_construct_agg(within).alias("bits"))
    field = np.zeros(1 << bits - 3, np.uint8)
    for r in blocks.collect():
        field[r.block << _FIELD_BLOCK - 3 : r.block + 1 << _FIELD_BLOCK - 3] = np.frombuffer(bytes(r.bits), np.uint8)
    return field


def may_hold(field: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = tn.mix64(ids.astype(np.uint64)) & np.uint64(len(field) * 8 - 1)
    return (field[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
