"""Mixing sources to target weights by a low-discrepancy schedule.

1. Targets. The mix has ``share`` of all words; sources in code point order (null
   last) weigh ``weights`` in turn; a target stops at ``epochs`` times its source's
   size and what is over is shared again by weight: every target is the smaller of
   that cap and level * weight, with one level for all (found by one pass over the
   sources in the order of cap / weight).
2. Schedule. Slot i of the mix is the golden-ratio point i * 2654435769 mod 2^32; the
   source whose part of the cumulative targets holds the point gets the slot, so
   every stretch of the schedule has the sources in proportion.
3. Blocks. Each source's documents in hash order are cut into blocks of
   ``block_words`` words. The slots of a source are ranked, and rank r takes block r
   modulo the number of blocks, at most ``epochs`` times.

Ranks and offsets are running sums in two levels, counts of small chunks first and
rows within a chunk then, so a source with most of the rows is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialise

GOLDEN = 2654435769  # odd, next to 2^32 / golden ratio
GRID = 1 << 32


@dataclass(frozen=True)
class Mix:
    """``share`` (as a fraction) of all words; ``salt`` changes the shuffle of the documents."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: tuple[int, int] = (3, 2)
    epochs: int = 2
    block_words: int = 32
    salt: str = "mix-1"


def sized(docs: DataFrame, mix: Mix, keep: tuple[str, ...]) -> DataFrame:
    """doc_id, the columns ``keep`` as one, source, size in words, and the shuffle position h (60 bits) of each row."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(mix.salt + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 15), 16, 10).cast("long")
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    kept = F.struct(*keep) if keep else F.lit(None).cast("int")
    return docs.select("doc_id", kept.alias("kept"), F.col("source").cast("string").alias("source"), size.alias("size"), h.alias("h"))


def targets(rows: DataFrame, mix: Mix) -> DataFrame:
    """One row a source: source, k (place in code point order), source_size, target, lo and hi (its part of the grid).

    All arithmetic up to the last division is on whole numbers. The window over all
    sources sees one row a source.
    """
    num, den = mix.share
    one = Window.partitionBy(F.lit(0))
    before = Window.unboundedPreceding
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in mix.weights]), (F.col("k") % len(mix.weights) + 1).cast("int"))
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("k", (F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1).cast("long")).withColumn("w", weight)
    s = s.withColumn("all", F.sum("source_size").over(one)).withColumn("cap", mix.epochs * F.col("source_size"))
    full = one.orderBy(F.col("cap") / F.col("w"), "k")
    s = s.withColumn("filled", F.sum("cap").over(full.rowsBetween(before, -1))).withColumn("open", F.sum("w").over(full.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("filled", F.coalesce("filled", F.lit(0)))
    s = s.withColumn("capped", den * (F.col("w") * F.col("filled") + F.col("cap") * F.col("open")) <= num * F.col("all") * F.col("w"))
    s = s.withColumn("left", num * F.col("all") - den * F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(one))
    s = s.withColumn("sharing", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("w"))).over(one))
    s = s.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise((F.col("w") * F.col("left")).cast("double") / (den * F.col("sharing")).cast("double")))
    s = s.withColumn("whole", F.floor("target"))
    s = s.withColumn("upto", F.sum("whole").over(one.orderBy("k").rowsBetween(before, 0))).withColumn("mixed", F.sum("whole").over(one))
    edge = lambda c: F.when(F.col("mixed") > 0, F.floor(c.cast("double") / F.col("mixed").cast("double") * float(GRID))).otherwise(0)
    return s.select("source", "k", "source_size", "target", "mixed", edge(F.col("upto") - F.col("whole")).alias("lo"), edge(F.col("upto")).alias("hi"))


def schedule(sources: DataFrame, mix: Mix) -> DataFrame:
    """slot, k, r: the source of each slot and the slot's rank within it, for all slots of the mix."""
    spark = sources.sparkSession
    mixed = sources.agg(F.max("mixed").alias("m")).first().m or 0
    slots = -(-mixed // mix.block_words)
    i = F.col("id")
    high = (F.shiftright(i, 16) % 65536 * GOLDEN) % GRID * 65536 % GRID
    point = (high + i.bitwiseAND(65535) * GOLDEN) % GRID
    points = spark.range(slots).select(i.alias("slot"), point.alias("u")).withColumn("cell", F.shiftright("u", 20))
    cells = sources.filter("hi > lo").select("k", "lo", "hi", F.explode(F.sequence(F.shiftright("lo", 20), F.shiftright(F.col("hi") - 1, 20))).alias("cell"))
    held = points.join(cells, "cell").filter("u >= lo and u < hi").select("slot", "k", F.shiftright("slot", 14).alias("chunk"))
    counts = held.groupBy("k", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("k").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("k", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inner = Window.partitionBy("k", "chunk").orderBy("slot")
    return held.join(counts, ["k", "chunk"]).select("slot", "k", (F.col("start") + F.row_number().over(inner) - 1).alias("r"))


def offsets(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with k, source_size, target and c: the words before a row in its source's shuffled order."""
    s, r = sources.alias("s"), rows.alias("r")
    placed = r.join(s, F.col("r.source").eqNullSafe(F.col("s.source"))).select("r.*", "k", "source_size", "target").withColumn("chunk", F.shiftright("h", 50))
    sums = placed.groupBy("k", "chunk").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("k").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("k", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inner = Window.partitionBy("k", "chunk").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(sums, ["k", "chunk"]).withColumn("c", F.col("start") + F.coalesce(F.sum("size").over(inner), F.lit(0))).drop("chunk", "start")


def mix_documents(docs: DataFrame, mix: Mix = Mix(), keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken (words that the mix takes of the row, repeats counted), and the columns ``keep``.

    Null or empty text: size 0, taken 0. Null sources form one source, the last.
    Repeated rows are rows of the mix each; rows of one doc_id follow each other by
    size. A null doc_id has a place in the shuffle too. An empty table gives an
    empty result. Columns other than doc_id, source, text and ``keep`` are not read.
    """
    rows = materialise(sized(docs, mix, keep), "mix-sizes")
    sources = materialise(targets(rows, mix), "mix-targets")
    placed = materialise(offsets(rows, sources), "mix-offsets")
    b = mix.block_words
    blocks = F.ceil(F.col("source_size") / b)
    turns = schedule(sources, mix).join(sources.select("k", "source_size"), "k").filter(F.col("r") < mix.epochs * blocks)
    taken = turns.groupBy("k", (F.col("r") % blocks).alias("block")).agg(F.count(F.lit(1)).alias("times"))
    cut = placed.filter("size > 0").select("k", "c", "size", F.explode(F.sequence(F.floor(F.col("c") / b), F.floor((F.col("c") + F.col("size") - 1) / b))).alias("block"))
    words = F.least(F.col("c") + F.col("size"), (F.col("block") + 1) * b) - F.greatest(F.col("c"), F.col("block") * b)
    got = cut.join(taken, ["k", "block"]).groupBy("k", "c").agg(F.sum(words * F.col("times")).alias("taken"))
    whole = placed.withColumn("at", F.when(F.col("size") > 0, F.col("c"))).join(got.withColumnRenamed("c", "at"), ["k", "at"], "left")
    return whole.select("doc_id", *[F.col(f"kept.`{c}`") for c in keep], "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                  CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
s1 AS (SELECT *, [3, 1, 2][k % 3 + 1] AS w, 2 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s0),
s2 AS (SELECT a.*, coalesce((SELECT CAST(sum(b.cap) AS BIGINT) FROM s1 b WHERE (b.cap / b.w, b.k) < (a.cap / a.w, a.k)), 0) AS filled,
              (SELECT CAST(sum(b.w) AS BIGINT) FROM s1 b WHERE (b.cap / b.w, b.k) >= (a.cap / a.w, a.k)) AS still FROM s1 a),
s3 AS (SELECT *, 2 * (w * filled + cap * still) <= 3 * total * w AS capped FROM s2),
s4 AS (SELECT *, CASE WHEN capped THEN CAST(cap AS DOUBLE)
              ELSE CAST(w * (3 * total - 2 * (SELECT coalesce(CAST(sum(cap) AS BIGINT), 0) FROM s3 WHERE capped)) AS DOUBLE)
                   / CAST(2 * (SELECT CAST(sum(w) AS BIGINT) FROM s3 WHERE NOT capped) AS DOUBLE) END AS target FROM s3),
s5 AS (SELECT *, CAST(floor(target) AS BIGINT) AS whole FROM s4),
s6 AS (SELECT *, (SELECT CAST(sum(whole) AS BIGINT) FROM s5) AS mixed, (SELECT CAST(sum(b.whole) AS BIGINT) FROM s5 b WHERE b.k <= a.k) AS upto FROM s5 a),
src AS (SELECT *, floor(CAST(upto - whole AS DOUBLE) / mixed * 4294967296.0) AS lo, floor(CAST(upto AS DOUBLE) / mixed * 4294967296.0) AS hi,
               CAST(ceil(source_size / 32) AS BIGINT) AS blocks FROM s6),
pts AS (SELECT i, (i * {GOLDEN}) % {GRID} AS u FROM (SELECT unnest(range((SELECT CAST(ceil(max(mixed) / 32) AS BIGINT) FROM src))) AS i)),
ranked AS (SELECT k, blocks, row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS r FROM pts JOIN src ON u >= lo AND u < hi),
times AS (SELECT k, r % blocks AS block, count(*) AS times FROM ranked WHERE r < 2 * blocks GROUP BY ALL),
pos AS (SELECT d.*, k, source_size, target, coalesce(CAST(sum(size) OVER (PARTITION BY k ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS c
        FROM d JOIN src ON d.source IS NOT DISTINCT FROM src.source),
cut AS (SELECT rid, k, c, size, unnest(range(c // 32, (c + size - 1) // 32 + 1)) AS block FROM pos WHERE size > 0),
got AS (SELECT rid, CAST(sum((least(c + size, (block + 1) * 32) - greatest(c, block * 32)) * times) AS BIGINT) AS taken FROM cut JOIN times USING (k, block) GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM pos LEFT JOIN got USING (rid)
"""
