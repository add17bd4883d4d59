"""Spelling variants of words by blocked Gram matrices.

1. Every whole text is cut into runs of letters; each task counts its words before the
   shuffle, so a frequent word is one row a batch.
2. A word is a vector of letter counts. One inserted, deleted or replaced code point
   changes its squared length distance to another word by at most two, and its length by
   at most one. So words meet in blocks of (length, length + 1).
3. Within a length, words are dealt over buckets by parts of their count vectors. The
   alphabet is cut into four parts; one edit changes the counts of two letters at most, so
   two near words agree on all counts of at least two parts, and meet in the bucket of one of
   the six pairs of parts. The number of buckets grows with the vocabulary, so a block keeps
   its size. Blocks above ``cell`` words are cut into rows of cells, each pair of which meets once.
4. In a block, a NumPy product of the count matrices gives all squared distances; pairs of
   at most two are compared code point by code point, and kept at exactly one edit.
5. A pair is reported by the first pair of parts on which it agrees, so once.

A word has at most (2 length + 1) * alphabet near words, so pairs stay in proportion to
the vocabulary whatever the groups.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import groups
from .scratch import discard, materialise, ship
from .textnum import mix64

#: a to z, and the letters of the runs above ASCII.
ALPHABET = 26 + 64
PARTS = 4
#: Pairs of alphabet parts that an edit may leave as they are.
KEPT = list(combinations(range(PARTS), 2))


@dataclass(frozen=True)
class Spelling:
    """min_chars, min_count: of a word; ratio: how many times more frequent a word's form is;
    deletion: one run of a document in so many loses a code point; bucket, cell: words of a block."""

    min_chars: int = 7
    min_count: int = 2
    ratio: int = 10
    deletion: int = 31
    bucket: int = 512
    cell: int = 1024


def run_words(doc_id: int | None, text: str, rules: Spelling) -> Counter:
    """The words of one text with their occurrences; a null doc_id is written as nothing in the hash."""
    out: Counter = Counter()
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    # bytes.lower() changes A-Z only
    lowered = text.encode().lower().decode()
    for run, n in Counter(re.findall("[a-zÀ-ÿ]{%d,}" % rules.min_chars, lowered)).items():
        h = zlib.crc32(run.encode(), start)
        if h % rules.deletion == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def vocabulary(docs: DataFrame, rules: Spelling = Spelling()) -> DataFrame:
    """word, n: words of at least ``min_chars`` code points with their occurrences in all texts, ``min_count`` at least."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for i, text in zip(batch.column("doc_id"), batch.column("text")):
                if text.is_valid:
                    seen.update(run_words(i.as_py(), text.as_py(), rules))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = rows.mapInArrow(count, "word string, n long").filter(F.length("word") >= rules.min_chars)
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= rules.min_count)


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after the other, and each word's length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.array([len(w) for w in words], np.int64)


def _letters(points: np.ndarray) -> np.ndarray:
    return np.where(points < 0x80, points - 0x61, points - 0xC0 + 26)


def letter_counts(words: list[str]) -> np.ndarray:
    """One row of ``ALPHABET`` counts for each word."""
    points, lengths = _points(words)
    at = np.repeat(np.arange(len(words)), lengths) * ALPHABET + _letters(points)
    return np.bincount(at, minlength=len(words) * ALPHABET).reshape(len(words), ALPHABET)


def part_keys(counts: np.ndarray) -> np.ndarray:
    """A 64-bit key of the counts of each pair of alphabet parts (letter i is of part i mod PARTS): words x KEPT."""
    weights = np.random.default_rng(13).integers(1, 1 << 63, ALPHABET, dtype=np.uint64) | np.uint64(1)
    parts = np.stack([(counts[:, p::PARTS].astype(np.uint64) * weights[p::PARTS]).sum(axis=1, dtype=np.uint64) for p in range(PARTS)], axis=1)
    return np.stack([mix64(parts[:, p]) ^ mix64(parts[:, q] + np.uint64(q)) for p, q in KEPT], axis=1)


def one_edit(a: list[str], b: list[str]) -> np.ndarray:
    """For pairs of words of n and of n or n + 1 code points (the same two lengths in all pairs): exactly one edit apart?"""
    n, m = len(a[0]), len(b[0])
    x, y = _points(a)[0].reshape(-1, n), _points(b)[0].reshape(-1, m)
    if n == m:
        return (x != y).sum(axis=1) == 1
    # equal up to the inserted code point, and equal behind it
    ahead, behind = x != y[:, :n], x != y[:, 1:]
    prefix = np.where(ahead.any(axis=1), ahead.argmax(axis=1), n)
    suffix = np.where(behind.any(axis=1), behind[:, ::-1].argmax(axis=1), n)
    return prefix + suffix >= n


def block_pairs(words: list[str], counts: np.ndarray, keys: np.ndarray, part: int, left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs (index, index) of the words ``left`` x ``right`` of one block that ``part`` is the first to agree on.

    ``same``: left and right are one list, and each of its pairs is taken once.
    """
    none = np.empty(0, np.int64)
    if not len(left) or not len(right):
        return none, none
    # sums of squares stay whole in float32 up to words of 2,000 letters, in float64 up to any length met
    kind = np.float32 if len(words[left[0]]) <= 2000 else np.float64
    a, b = counts[left].astype(kind), counts[right].astype(kind)
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    i, j = np.nonzero(squares <= 2)
    if same:
        i, j = i[i < j], j[i < j]
    i, j = left[i], right[j]
    agree = keys[i] == keys[j]
    mine = agree[:, part] & ~agree[:, :part].any(axis=1)
    i, j = i[mine], j[mine]
    if not len(i):
        return none, none
    step = max(1, (1 << 22) // max(len(words[i[0]]), 1))
    near = np.concatenate([
        one_edit([words[x] for x in i[lo:lo + step]], [words[x] for x in j[lo:lo + step]]) for lo in range(0, len(i), step)])
    return i[near], j[near]


def near_words(words: DataFrame, rules: Spelling = Spelling()) -> DataFrame:
    """word, near, near_n: every word with each of its near words (both directions)."""
    spark = words.sparkSession
    ship(spark)
    buckets = max(1, -(-words.count() // (rules.bucket * 4)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column("word").to_pylist()
            keys = part_keys(letter_counts(texts))
            lengths = np.array([len(t) for t in texts])
            for part in range(len(KEPT)):
                bucket = (keys[:, part] % np.uint64(buckets)).astype(np.int64)
                for side in (0, 1):  # of its own length's block, and one longer than the block before
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(texts), part), pa.int32()), pa.array(lengths - side, pa.int32()), pa.array(bucket, pa.int64()),
                         pa.array(np.full(len(texts), side), pa.int32()), batch.column("word"), batch.column("n")],
                        ["part", "length", "bucket", "side", "word", "n"])

    block = ["part", "length", "bucket"]
    dealt = words.mapInArrow(deal, "part int, length int, bucket long, side int, word string, n long")
    # blocks of more than ``cell`` words of one length: a row of words meets each other row in a cell of its own
    sizes = materialise(dealt.groupBy(*block).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 2 * rules.cell), "spelling-blocks")
    rows = F.coalesce(F.ceil(F.col("size") / (2 * rules.cell)), F.lit(1)).cast("int")
    spread = dealt.join(sizes, block, "left").withColumn("rows", rows).withColumn("row", F.pmod(F.xxhash64("word"), "rows").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("rows") - 1))
    cells = spread.select("*", other.alias("other")).withColumns({
        "low": F.least("row", "other"), "high": F.greatest("row", "other")}).withColumn("cell", F.xxhash64(*block, "low", "high"))
    # the full block identity keeps two blocks of one hash apart
    named = cells.withColumn("name", F.concat_ws(":", *block, "low", "high")).select("cell", "name", "part", "side", "row", "low", "high", "word", "n")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "name"):
            texts, n = group.column("word").to_pylist(), group.column("n").to_numpy()
            part, low, high = (group.column(c)[0].as_py() for c in ("part", "low", "high"))
            side, row = group.column("side").to_numpy(), group.column("row").to_numpy()
            counts = letter_counts(texts)
            keys = part_keys(counts)
            pick = lambda s, r: np.flatnonzero((side == s) & (row == r))
            found = [block_pairs(texts, counts, keys, part, pick(0, low), pick(0, high), low == high),
                     block_pairs(texts, counts, keys, part, pick(0, low), pick(1, high), False)]
            if low != high:
                found.append(block_pairs(texts, counts, keys, part, pick(0, high), pick(1, low), False))
            i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            i, j = np.concatenate([i, j]), np.concatenate([j, i])
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([texts[x] for x in i], pa.string()), pa.array([texts[x] for x in j], pa.string()), pa.array(n[j], pa.int64())],
                    ["word", "near", "near_n"])

    return named.repartition("cell").sortWithinPartitions("name").drop("cell").mapInArrow(compare, "word string, near string, near_n long")


def follow(forms: DataFrame, longest: int) -> DataFrame:
    """word, root: the last word of each chain of ``forms`` (word, form), no chain being longer than ``longest``.

    Every round doubles the steps taken, so a chain of L steps needs log2(L) joins.
    """
    at = forms.select("word", F.col("form").alias("root"))
    taken = 1
    while taken < longest:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialise(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-root")
        if taken > 1:
            discard(at)
        at = step
        taken *= 2
    return at


def variants(docs: DataFrame, rules: Spelling = Spelling()) -> DataFrame:
    """word, n, n_near, form, form_n, root: one row for each word of the vocabulary.

    Null and empty texts have no words; a null doc_id is written as nothing before the
    colon of the hash. Repeated rows count again. Near words of equal n are taken in
    code-point order. An empty table gives an empty result. Only doc_id and text are
    read, so other columns cannot clash. A form is at least ``ratio`` times as frequent,
    so chains are as short as the digits of the largest n.
    """
    words = materialise(vocabulary(docs, rules), "spelling-words")
    near = near_words(words, rules).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("form"))).alias("best"))
    best_n = -F.col("best.rank")
    formed = best_n >= F.lit(rules.ratio) * F.col("n")
    listed = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best.form")).alias("form"), F.when(formed, best_n).alias("form_n")), "spelling-forms")
    most = listed.agg(F.max("n")).first()[0] or 1
    chain = 1
    while rules.ratio ** chain <= most:
        chain += 1
    roots = follow(listed.filter("form IS NOT NULL"), chain)
    return listed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
