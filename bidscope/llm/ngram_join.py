"""N-gram Jaccard join with several global token orders.

A document's set is its distinct shingles of ``width`` lower-cased words (fewer
words: the whole sequence as one). Documents whose sets have a Jaccard similarity of
``similarity`` or more are linked; what is returned are the components of the links.

1. Documents with equal sets form a class, known by its smallest doc_id.
2. Three global orders of all shingles: from rare to frequent by hashed counts over
   the whole corpus, ties broken by three independent hashes. Similar sets share a
   shingle of their prefixes under every order.
3. Candidates share a prefix shingle under the first order and pass the length and
   positional filters (``setjoin``). Their prefixes under the other orders are
   intersected next, and pairs that share none under one of them go, as do pairs
   whose parity signatures differ in more bits than similar sets can.
4. What is left is verified on the texts' own shingle sets.

A family of near copies is not listed pair by pair: the first round verifies each
class's earliest candidates of each posting list, and the links found make components.
Each further round takes, for every class, its earliest few candidates in each other
component, verifies those that are new and merges components, with more tries a round,
until no posting list holds a candidate back. A pair inside a component can add
nothing, so no link between components is lost.
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
from .components import components
from .line_dedup import postings
from .rarity import classes, hashed_counts
from .scratch import discard, materialise, ship

ORDERS = (np.uint64(0), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


@dataclass(frozen=True)
class NgramJoin:
    """``tries``: candidates of a posting list that are verified in the first round (and ``growth`` times as many in each
    one after it); ``cell``: sets of a posting list that meet in one group."""

    width: int = 4
    similarity: Fraction = Fraction(17, 20)
    tries: int = 2
    growth: int = 4
    cell: int = setjoin.CELL


class _Sets:
    """Sorted distinct shingle hashes of a run of texts."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, width: int):
        buf = tn.LOWER[buf]
        starts, ends, first = tn.spans(buf, offsets, tn.SPACE_WORD)
        words = tn.span_hash(buf, starts, ends)
        grams, begin = tn.windows(words, first, width)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(begin))
        count = np.diff(first)
        for i in np.flatnonzero((count > 0) & (count < width)).tolist():
            whole, _ = tn.windows(words[first[i] : first[i + 1]], np.array([0, count[i]]), int(count[i]))
            grams, owner = np.append(grams, whole), np.append(owner, i)
        order = np.lexsort((grams, owner))
        owner, grams = owner[order], grams[order]
        fresh = np.ones(len(owner), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])
        self.owner, self.token = owner[fresh], grams[fresh]
        self.begin = np.searchsorted(self.owner, np.arange(len(offsets)))
        self.n = np.diff(self.begin)
        sums = lambda v: np.concatenate((np.zeros(1, np.uint64), np.cumsum(v, dtype=np.uint64)))
        total = lambda v: sums(v)[self.begin[1:]] - sums(v)[self.begin[:-1]]
        self.name = tn.mix64(total(tn.mix64(self.token ^ np.uint64(0xA5A5))) + self.n.astype(np.uint64)).astype(np.int64)
        self.check = total(tn.mix64(self.token ^ np.uint64(0x5A5A))).astype(np.int64)

    def prefixes(self, class_of: np.ndarray, salt: np.uint64, length: np.ndarray) -> list[bytes]:
        """The first ``length`` shingles (32 bits each) of every set, in the order of (rarity, hash with this salt)."""
        rarity = class_of[(self.token & np.uint64(len(class_of) - 1)).astype(np.int64)].astype(np.uint64)
        rank = rarity << np.uint64(56) | tn.mix64(self.token ^ salt) >> np.uint64(8)
        order = np.lexsort((rank, self.owner))
        short = (self.token[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return [short[b : b + k].tobytes() for b, k in zip(self.begin[:-1].tolist(), length.tolist())]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))


def _counts(texts: DataFrame, join: NgramJoin) -> np.ndarray:
    def tokens(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, buf, offsets in tn.pieces(batch.column("text")):
            yield _Sets(buf, offsets, join.width).token

    return hashed_counts(texts.select("text"), tokens)


def sets_of(texts: DataFrame, join: NgramJoin) -> DataFrame:
    """doc, name, check (128 bits that name the set) and n of each row's whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in tn.pieces(batch.column("text")):
                x = _Sets(buf, offsets, join.width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(lo, hi - lo), pa.array(x.name, pa.int64()), pa.array(x.check, pa.int64()), pa.array(x.n, pa.int32())],
                    ["doc", "name", "check", "n"],
                )

    return texts.mapInArrow(run, "doc long, name long, check long, n int")


def classes_of(texts: DataFrame, class_of, join: NgramJoin) -> DataFrame:
    """One row for each distinct set: name, check, doc (its smallest doc_id), n, prefixes under three orders, parity signature, id (a number)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in schema.split(", ")]
        for batch in batches:
            docs = batch.column("doc").to_numpy(zero_copy_only=False)
            for lo, hi, buf, offsets in tn.pieces(batch.column("text")):
                x = _Sets(buf, offsets, join.width)
                length = np.where(x.n > 0, setjoin.prefix_length(join.similarity, x.n), 0)
                # Of equal sets of this run the smallest doc_id's row goes on.
                at = np.lexsort((docs[lo:hi], x.check, x.name))
                new = np.ones(len(at), bool)
                new[1:] = (x.name[at[1:]] != x.name[at[:-1]]) | (x.check[at[1:]] != x.check[at[:-1]])
                at = np.sort(at[new & (x.n[at] > 0)])
                found = [x.prefixes(class_of.value, salt, length) for salt in ORDERS]
                bits = 1 << np.clip(np.ceil(np.log2(np.maximum(x.n, 1) * 4.0)), 8, 16).astype(np.int64)
                signs, start = setjoin.parity(x.token, x.begin, bits)
                found.append([signs[a:b].tobytes() for a, b in zip(start[:-1].tolist(), start[1:].tolist())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.name[at], pa.int64()), pa.array(x.check[at], pa.int64()), pa.array(docs[lo:hi][at], pa.int64()),
                     pa.array(x.n[at], pa.int32()), *[pa.array([f[i] for i in at.tolist()], pa.binary()) for f in found]],
                    names,
                )

    schema = "name long, check long, doc long, n int, prefix binary, second binary, third binary, parity binary"
    rows = texts.filter("doc is not null").mapInArrow(run, schema)
    whole = rows.groupBy("name", "check").agg(F.min("doc").alias("doc"), *[F.min(c).alias(c) for c in ("n", "prefix", "second", "third", "parity")])
    return whole.withColumn("id", F.monotonically_increasing_id())


def _links(pairs: DataFrame, firsts: DataFrame, texts: DataFrame, join: NgramJoin) -> DataFrame:
    """Of pairs (a, b) of classes, each there once, those that are linked: filtered by the other orders, then verified on the texts."""
    spark = pairs.sparkSession
    field = spark.sparkContext.broadcast(setjoin.members(pairs.select(F.explode(F.array("a", "b")).alias("id"))))

    def concerned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(setjoin.may_hold(field.value, batch.column("id").to_numpy(zero_copy_only=False))))

    def possible(a: tuple, b: tuple) -> bool:
        signs = setjoin.fold([a[3], b[3]])
        if int(np.bitwise_count(signs[0] ^ signs[1]).sum()) > setjoin.differing_most(join.similarity, a[0], b[0]):
            return False
        return all(len(np.intersect1d(x, y)) for x, y in zip(a[1:3], b[1:3]))

    def unpacked(p: dict) -> tuple:
        return p["n"], np.frombuffer(p["second"], np.uint32), np.frombuffer(p["third"], np.uint32), p["parity"]

    orders = F.struct("n", "second", "third", "parity").alias("payload")
    held = firsts.select("id", orders).mapInArrow(concerned, "id long, payload struct<n:int,second:binary,third:binary,parity:binary>")
    left = materialise(setjoin.compare(pairs, held, possible, unpacked), "ngram-filtered")

    wanted = left.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(firsts.select("id", "name", "doc"), "id")
    wanted = materialise(wanted, "ngram-wanted")
    documents = spark.sparkContext.broadcast(setjoin.members(wanted.select("doc")))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(setjoin.may_hold(documents.value, batch.column("doc").to_numpy(zero_copy_only=False))))
            for lo, hi, buf, offsets in tn.pieces(batch.column("text")):
                own = pa.array(_Sets(buf, offsets, join.width).name, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(lo, hi - lo), own, batch.column("text").slice(lo, hi - lo)], ["doc", "name", "payload"])

    # A doc_id may stand on rows with other texts; only those whose set is the class's count.
    near = texts.filter("doc is not null").mapInArrow(needed, "doc long, name long, payload string").hint("merge").join(wanted, ["doc", "name"])
    payloads = materialise(near.groupBy("doc", "name", "id").agg(F.min("payload").alias("payload")).select("id", "payload"), "ngram-texts")
    num, den = join.similarity.numerator, join.similarity.denominator

    def similar(a: np.ndarray, b: np.ndarray) -> bool:
        both = np.intersect1d(a, b, assume_unique=True).size
        return den * both >= num * (a.size + b.size - both)

    def shingles(text: str) -> np.ndarray:
        raw = text.encode()
        return _Sets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), join.width).token

    out = materialise(setjoin.compare(left, payloads, similar, shingles), "ngram-verified")
    discard(left, wanted, payloads)
    return out


def ngram_components(docs: DataFrame, join: NgramJoin = NgramJoin()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row's whole text.

    component_id is the smallest doc_id that links lead to, the row's own included.
    Null or empty text: an empty set, linked with nothing. Rows of one doc_id are one
    document, linked through each of its texts. A null doc_id is linked with nothing
    and has a null component. An empty table gives an empty result; other columns are
    not read.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = _texts(docs)
    class_of = spark.sparkContext.broadcast(classes(_counts(texts, join)))
    seen = materialise(sets_of(texts, join), "ngram-sets")
    firsts = materialise(classes_of(texts, class_of, join), "ngram-classes")
    listed = postings(firsts, class_of, join.cell, setjoin.POSTING)
    found = materialise(setjoin.first_candidates(listed, join.similarity, setjoin.POSTING, join.tries), "ngram-candidates")

    member = seen.filter("n > 0 and doc is not null").join(firsts.select("name", "check", "id", F.col("doc").alias("head")), ["name", "check"])
    # Rows of one doc_id with different sets link those sets' classes.
    several = member.groupBy("doc").agg(F.min("id").alias("u"), F.max("id").alias("high")).filter("u < high").select("doc", "u")
    tried = materialise(found.filter("a is not null").select("a", "b").distinct(), "ngram-tried")
    edges = _links(tried, firsts, texts, join).toDF("u", "v").unionByName(member.join(several, "doc").select("u", F.col("id").alias("v")))
    roots = components(edges)

    tries = join.tries
    while True:
        held = found.filter("a is null").drop("a", "b").join(firsts.select("id", "parity"), "id")
        tagged = held.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("tag", F.coalesce("root", "id"))
        spent, found = found, materialise(setjoin.across_candidates(tagged, join.similarity, setjoin.POSTING, tries), "ngram-open")
        discard(spent)
        new = materialise(found.filter("a is not null").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "ngram-new")
        if not new.isEmpty():
            tried = tried.unionByName(new)
            # the components so far stand for all earlier links
            roots = components(roots.toDF("u", "v").unionByName(_links(new, firsts, texts, join).toDF("u", "v")))
        if found.filter("a is null").isEmpty():
            break
        tries *= join.growth
    smallest = roots.join(firsts.select(F.col("id").alias("node"), "doc"), "node").groupBy("root").agg(F.min("doc").alias("smallest"))
    named = roots.join(smallest, "root").select(F.col("node").alias("id"), "smallest")
    heads = member.select("doc", "head", "id").distinct().join(named, "id", "left")
    own = heads.groupBy("doc").agg(F.min(F.coalesce("smallest", "head")).alias("component_id"))
    return seen.join(own, "doc", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id")
    )
