"""Near-duplicate lines by an exact set-similarity join.

A line's set is its distinct words (`[^\\x20\\x09-\\x0D]+`). Every line with a word takes
part (or with ``min_words``). A line goes if an earlier line of the corpus, in order of
(doc_id, line number), has a Jaccard similarity of ``similarity`` or more, whether or not
that line stays itself: the outcome does not depend on the order of work. Rows of one
doc_id come one after the other, in order of their texts' digests.

1. Lines with equal sets form a class, known by its first line; only this one can stay.
2. Words are ordered from rare to frequent by hashed counts over all documents. A
   class posts the words of its prefix; lists meet under length and positional filters
   (``setjoin``).
3. Candidates are verified on the lines' own words, the texts read again for the lines
   concerned. A class with a verified earlier match goes.
4. The lines to remove, by document, meet the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import setjoin
from . import textnum as tn
from .rarity import ONCE, at_most, classes, hashed_counts
from .scratch import discard, materialise, ship

#: doc_id of rows without one in the order of lines: after all others.
LAST = (1 << 63) - 1
_NOT_BREAK = np.ones(256, bool)
_NOT_BREAK[0x0A] = False
OCCURRENCE = "name long, check long, doc long, line int, n int, prefix binary, s0 long, s1 long"
#: Bits of a line's parity signature.
SIGN = 128
#: Bytes of text that are cut into lines and words together: the working arrays (8 bytes a byte) stay in a core's cache.
RUN = 1 << 18


@dataclass(frozen=True)
class LineJoin:
    """``tries``: candidates of a list that are verified in the first round (the second has the rest); ``cell``: sets of a posting list that meet in one group."""

    similarity: Fraction = Fraction(4, 5)
    min_words: int = 1
    tries: int = 3
    cell: int = setjoin.CELL


def _only_equal(t: Fraction, n: np.ndarray) -> np.ndarray:
    """Sets so small that no other set is similar: one word more or less is too much."""
    return t.denominator * n < t.numerator * (n + 1)


class _Lines:
    """Lines of a run of texts with their distinct words, rarest first when ``class_of`` is given."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, min_words: int, class_of: np.ndarray | None = None):
        starts, ends, _ = tn.spans(buf, offsets, tn.SPACE_WORD)
        l_starts, l_ends, _ = tn.spans(buf, offsets, _NOT_BREAK)
        low, high = np.searchsorted(starts, l_starts), np.searchsorted(starts, l_ends)
        long = high - low >= min_words
        l_starts, l_ends, low, high = l_starts[long], l_ends[long], low[long], high[long]
        self.text = np.searchsorted(offsets, l_starts, "right") - 1
        breaks = np.flatnonzero(buf == 0x0A)
        self.line = np.searchsorted(breaks, l_starts) - np.searchsorted(breaks, offsets[self.text])
        self.span = (l_starts, l_ends)
        words = tn.span_hash(buf, starts, ends)
        owner = np.repeat(np.arange(len(low)), high - low)
        at = np.arange(len(owner)) - np.concatenate(([0], np.cumsum(high - low)))[owner] + low[owner]
        token = words[at]
        rank = tn.mix64(token)
        if class_of is not None:
            rarity = class_of[(token & np.uint64(len(class_of) - 1)).astype(np.int64)].astype(np.uint64)
            rank = rarity << np.uint64(56) | rank >> np.uint64(8)
        # Words of a line by rank: the line's number over the leading bits of the rank, as one key.
        if len(low) < 1 << 20:
            order = np.argsort(owner.astype(np.uint64) << np.uint64(44) | rank >> np.uint64(20))
        else:
            order = np.lexsort((rank, owner))
        owner, token = owner[order], token[order]
        fresh = np.ones(len(owner), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])
        owner, self.token = owner[fresh], token[fresh]
        self.begin = np.searchsorted(owner, np.arange(len(low) + 1))
        self.n = np.diff(self.begin)
        if class_of is not None:
            signs, _ = setjoin.parity(self.token, self.begin, np.full(len(low), SIGN))
            self.signs = signs.view(np.int64).reshape(-1, 2) if len(low) else np.empty((0, 2), np.int64)
        total = lambda v: np.add.reduceat(v, self.begin[:-1]) if len(low) else np.empty(0, np.uint64)
        self.name = tn.mix64(total(tn.mix64(self.token ^ np.uint64(0xA5A5)))).astype(np.int64)
        self.check = total(tn.mix64(self.token ^ np.uint64(0x5A5A))).astype(np.int64)


def _takes_part(line: str, min_words: int) -> bool:
    """Whether a line has so many words."""
    if min_words == 1:
        return bool(line.strip(" \t\n\r\x0b\x0c"))
    return len(line.encode().split()) >= min_words


def placed(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, ``keep`` and doc: each row's place among the rows, a number of its own.

    Where doc_ids are ids, they are the places. Rows that share one (or have none) need numbers: all
    rows are then dealt by (doc_id, digest of the text, place in the input), so that a hot id is spread
    over tasks, numbered in this order and written.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), *keep, F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"))
    if not rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
        return rows
    order = ("doc", "digest", "place")
    rows = rows.withColumns({"digest": F.sha2(F.coalesce("text", F.lit("")), 256), "place": F.monotonically_increasing_id()})
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(sorted_rows.select("doc_id", "text", *keep, F.monotonically_increasing_id().alias("doc")), "line-rows")


def _word_counts(docs: DataFrame) -> np.ndarray:
    def words(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, buf, offsets in tn.pieces(batch.column("text"), RUN):
            starts, ends, _ = tn.spans(buf, offsets, tn.SPACE_WORD)
            yield tn.span_hash(buf, starts, ends)

    return hashed_counts(docs.select("text"), words)


def occurrences(texts: DataFrame, class_of, join: LineJoin) -> DataFrame:
    """Every long line: its class (name, check), place, set size, prefix (32 bits a word) and parity signature.

    Of equal lines of one run of texts only the first carries the prefix; it is
    empty if a set of this size matches only its equals, which share its class.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in OCCURRENCE.split(", ")]
        for batch in batches:
            docs = batch.column("doc").to_numpy(zero_copy_only=False)
            for lo, hi, buf, offsets in tn.pieces(batch.column("text"), RUN):
                x = _Lines(buf, offsets, join.min_words, class_of.value)
                length = np.where(_only_equal(join.similarity, x.n), 0, setjoin.prefix_length(join.similarity, x.n))
                short = (x.token & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                new = np.zeros(len(x.n), bool)
                new[np.unique(x.name, return_index=True)[1]] = True
                words = np.where(new, length, 0)
                ends = np.concatenate(([0], np.cumsum(words)))
                owner = np.repeat(np.arange(len(words)), words)
                data = short[np.arange(len(owner)) - ends[owner] + x.begin[owner]]
                bits = np.packbits(new, bitorder="little")
                prefix = pa.Array.from_buffers(pa.binary(), len(new), [pa.py_buffer(bits), pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.name, pa.int64()), pa.array(x.check, pa.int64()), pa.array(docs[lo:hi][x.text], pa.int64()), pa.array(x.line, pa.int32()),
                     pa.array(x.n, pa.int32()), prefix, pa.array(x.signs[:, 0], pa.int64()), pa.array(x.signs[:, 1], pa.int64())],
                    names,
                )

    return texts.mapInArrow(run, OCCURRENCE)


def postings(found: DataFrame, class_of, cell_size: int, schema: str) -> DataFrame:
    """Posting rows of the sets' prefixes, but for tokens that stand in one place only."""
    signed = [c for c in ("s0", "s1") if c in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tn.flat(batch.column("prefix"))
            token = data.view(np.uint32)
            begin = offsets // 4
            owner = np.repeat(np.arange(batch.num_rows), np.diff(begin))
            pos = np.arange(len(token)) - begin[owner]
            rarity = class_of.value[(token & np.uint32(len(class_of.value) - 1)).astype(np.int64)]
            shared = rarity > ONCE
            token, owner, pos, rarity = token[shared], owner[shared], pos[shared], rarity[shared]
            col = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
            ids = col("id")[owner]
            at, cell, side = setjoin.deal(token, ids, at_most(rarity), cell_size)
            who = owner[at]
            yield setjoin.rows(schema, (token.view(np.int32)[at], cell, side, ids[at], col("n")[who], pos[at], *[col(c)[who] for c in signed]))

    return found.select("id", "n", "prefix", *signed).mapInArrow(run, schema)


def _place(doc, line):
    """Places of lines as one number, equal for equal places."""
    return doc ^ line.astype(np.int64) << 40


def _verified(pairs: DataFrame, firsts: DataFrame, texts: DataFrame, join: LineJoin) -> DataFrame:
    """The pairs whose lines are similar, by their words. The texts are read for the lines at the classes' places only."""
    spark = pairs.sparkSession
    pairs = materialise(pairs.distinct(), "line-pairs")
    wanted = materialise(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(firsts.select("id", "doc", "line"), "id"), "line-wanted")
    place = F.col("doc").bitwiseXOR(F.shiftleft(F.col("line").cast("long"), 40))
    field = spark.sparkContext.broadcast(setjoin.members(wanted.select(place)))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc").to_numpy(zero_copy_only=False)
            for lo, hi, buf, offsets in tn.pieces(batch.column("text"), RUN):
                starts, ends, first = tn.spans(buf, offsets, _NOT_BREAK)
                text = np.repeat(np.arange(hi - lo), np.diff(first))
                breaks = np.flatnonzero(buf == 0x0A)
                line = (np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[text])).astype(np.int32)
                doc = docs[lo:hi][text]
                at = np.flatnonzero(setjoin.may_hold(field.value, _place(doc, line)))
                raw = [buf[s:e].tobytes() for s, e in zip(starts[at].tolist(), ends[at].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(doc[at], pa.int64()), pa.array(line[at], pa.int32()), pa.array(raw, pa.binary())], ["doc", "line", "payload"])

    found = texts.select("doc", "text").mapInArrow(lines, "doc long, line int, payload binary")
    payloads = materialise(wanted.join(found, ["doc", "line"]).select("id", "payload"), "line-texts")
    num, den = join.similarity.numerator, join.similarity.denominator

    def similar(a: frozenset, b: frozenset) -> bool:
        shared = len(a & b)
        return den * shared >= num * (len(a) + len(b) - shared)

    out = materialise(setjoin.compare(pairs, payloads, similar, lambda raw: frozenset(bytes(raw).split())), "line-similar")
    discard(pairs, wanted, payloads)
    return out


def kept_lines(rows: DataFrame, join: LineJoin = LineJoin()) -> DataFrame:
    """doc, line of every line of ``placed`` rows that takes part and stays: the first of its class, with no earlier match."""
    spark = rows.sparkSession
    ship(spark)
    texts = rows.select("doc", "text")
    class_of = spark.sparkContext.broadcast(classes(_word_counts(texts)))
    seen = materialise(occurrences(texts, class_of, join), "line-occurrences")
    firsts = seen.groupBy("name", "check").agg(
        F.min(F.struct("doc", "line")).alias("first"), *[F.max(c).alias(c) for c in ("n", "prefix", "s0", "s1")]
    ).select("first.doc", "first.line", "n", "prefix", "s0", "s1")
    # Numbers in the order of first lines; the written table fixes them.
    firsts = firsts.repartitionByRange("doc", "line").sortWithinPartitions("doc", "line").withColumn("id", F.monotonically_increasing_id())
    firsts = materialise(firsts, "line-classes")
    discard(seen)
    listed = postings(firsts, class_of, join.cell, setjoin.SIGNED)
    found = materialise(setjoin.first_candidates(listed, join.similarity, setjoin.SIGNED, join.tries), "line-candidates")
    similar = _verified(found.filter("a is not null").select("a", "b"), firsts, texts, join)
    gone = materialise(similar.select(F.col("b").alias("id")).distinct(), "line-gone")
    held = found.filter("a is null").drop("a", "b")
    tagged = held.join(gone.withColumn("tag", F.lit(1).cast("long")), "id", "left").fillna(0, ["tag"])
    rest = materialise(setjoin.open_candidates(tagged, join.similarity, setjoin.SIGNED), "line-open")
    discard(found)
    if rest.limit(1).count():
        again = _verified(rest, firsts, texts, join)
        gone = materialise(gone.unionByName(again.select(F.col("b").alias("id"))).distinct(), "line-gone")
    out = materialise(firsts.select("id", "doc", "line").join(gone, "id", "left_anti").select("doc", "line"), "line-kept")
    discard(firsts, gone)
    return out


def dedup_lines(docs: DataFrame, join: LineJoin = LineJoin(), keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text without the removed lines, n_lines, n_removed and the columns ``keep``, one row for each input row.

    Lines are split at \\n; lines of fewer than ``min_words`` words and blank ones stay. A text of which
    nothing but blank lines is left is the empty string. Null text: null, no lines.
    Rows of one doc_id follow each other in order of their texts' digests, and rows without
    one come last, so a line of two equal rows stays in one of them. An empty table gives an
    empty result; other columns are not read.
    """
    rows = placed(docs, keep)
    # one row has the lines of one text, so its list is no longer than the text
    stay = kept_lines(rows, join).groupBy("doc").agg(F.collect_list("line").alias("stay"))
    rows = rows.join(stay, "doc", "left").select("doc_id", "text", *keep, "stay")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_removed = [], [], []
            for text, stay in zip(batch.column("text").to_pylist(), batch.column("stay").to_pylist()):
                lines = text.split("\n") if text else []
                stays = set(stay or ())
                left = [s for k, s in enumerate(lines) if k in stays or not _takes_part(s, join.min_words)]
                if len(left) < len(lines):
                    text = "\n".join(left) if any(_takes_part(s, 1) for s in left) else ""
                texts.append(text)
                n_lines.append(len(lines))
                n_removed.append(len(lines) - len(left))
            kept = [batch.column(c) for c in ("doc_id", *keep)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], ["doc_id", *keep, "text", "n_lines", "n_removed"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select("doc_id", *keep).schema)
    return rows.mapInArrow(run, f"{fields}, text string, n_lines long, n_removed long")


def digests(kept: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the digest of the text that stays."""
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))

