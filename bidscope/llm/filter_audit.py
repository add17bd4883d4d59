"""Filter interaction audit by the Hart-Mas-Colell potential.

Each part (source) of the documents is a game: its players are the filters, and the
value of a coalition is the number of documents that fail at least one of its filters.

1. Every whole text is measured once and becomes one bit mask of the filters it fails.
2. The masks are counted by part and label; the counts give the value of each of the
   2^k coalitions (32 for five filters), for all, good and toxic documents.
3. The potential of a coalition S is ``P(S) = (v(S) + sum of P(S without i)) / |S|`` with
   ``P(empty) = 0``, level by level. A filter's Shapley value is
   ``P(all) - P(all without it)``. Potentials are kept times k!, which makes them whole
   numbers, and Shapley values times k! are the sums over all k! orders.
4. A step of an order removes ``v(before + filter) - v(before)`` documents, so all
   orders and steps come from the coalitions, never from the documents again.

A duplicate fails a filter only by a smaller doc_id of the same text anywhere in the
table. Its text is known by its SHA-256; the first doc_id of each text is found by an
aggregation and met by (text, doc_id), so copies of one text spread over all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import materialise

#: Letters of the filters in the order of the mask's bits; the last one is the duplicate filter.
LETTERS = "ABCDE"
_WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class AuditRules:
    """Thresholds of the filters A to D (E has none)."""

    min_words: int = 50
    min_distinct_pct: int = 65
    max_upper_pct: int = 5
    symbols: str = "#$%&*|"

    def failures(self, text: Column, words: Column, distinct: Column) -> list[Column]:
        """Conditions under which a text fails A, B, C and D."""
        upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
        return [
            words < self.min_words,
            100 * distinct < self.min_distinct_pct * words,
            100 * upper > self.max_upper_pct * F.length(text),
            F.length(F.translate(text, self.symbols, "")) < F.length(text),
        ]


def _mask(conditions: list[Column]) -> Column:
    return sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)), F.lit(0))


def measured(docs: DataFrame, rules: AuditRules, part_col: str) -> DataFrame:
    """doc_id, part, mask of A to D and the SHA-256 of the whole text, one row for each input row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
    rows = rows.withColumns({"n_words": F.size("words"), "n_distinct": F.size(F.array_distinct("words"))})
    mask = _mask(rules.failures(F.col("text"), F.col("n_words"), F.col("n_distinct")))
    return rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("key"))


def histogram(docs: DataFrame, labels: DataFrame, rules: AuditRules = AuditRules(), part_col: str = "source") -> DataFrame:
    """part, mask (bits of LETTERS), good, toxic, n: documents by the filters they fail and their labels."""
    rows = materialise(measured(docs, rules, part_col), "audit")
    known = rows.filter("doc_id IS NOT NULL")
    # Copies of a text are many rows but one first; (key, doc_id) spreads them over all tasks.
    counted = rows.groupBy("key", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    firsts = known.groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    later = F.col("first").isNull() & F.col("doc_id").isNotNull()
    masked = counted.join(firsts, ["key", "doc_id"], "left").select(
        "doc_id", "part", "n", (F.col("mask") + F.when(later, 1 << (len(LETTERS) - 1)).otherwise(0)).alias("mask"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("q"), F.col("toxic").alias("t")).groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("q") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("t") == 1), F.lit(False)).alias("toxic"))
    return masked.join(marks, "doc_id", "left").groupBy(
        "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(F.sum("n").alias("n"))


def coalitions(counts: DataFrame, k: int = len(LETTERS)) -> DataFrame:
    """part, coalition (0 to 2^k - 1), documents of the part, and removed, good and toxic ones among those the coalition removes."""
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    return counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << k) - 1)))).groupBy("part", "coalition").agg(
        F.sum("n").alias("documents"),
        *[F.sum(F.when(hit & c, F.col("n")).otherwise(0)).alias(name) for name, c in (("removed", F.lit(True)), ("good", F.col("good")), ("toxic", F.col("toxic")))])


def potentials(values: DataFrame, k: int = len(LETTERS)) -> DataFrame:
    """One row a part: the coalitions' values as arrays (removed, good, toxic), their ``potential`` and each
    filter's ``shapley``, the last two times k!.

    A part has 2^k coalitions, so the arrays are bounded.
    """
    kinds = ("removed", "good", "toxic")
    games = values.groupBy("part").agg(F.max("documents").alias("documents"), F.sort_array(F.collect_list(F.struct("coalition", *kinds))).alias("v"))
    games = games.select("part", "documents", *[F.col(f"v.{c}").alias(c) for c in kinds]).withColumn("p0", F.lit(0).cast("long"))
    whole = (1 << k) - 1
    for size in range(1, k + 1):
        level = {}
        for s in (s for s in range(1, whole + 1) if s.bit_count() == size):
            smaller = " + ".join(f"p{s ^ (1 << i)}" for i in range(k) if s >> i & 1)
            level[f"p{s}"] = F.expr(f"({factorial(k)} * removed[{s}] + {smaller}) div {size}")
        games = games.withColumns(level)
    return games.select(
        "part", "documents", *kinds, F.array(*[F.col(f"p{s}") for s in range(whole + 1)]).alias("potential"),
        F.array(*[F.col(f"p{whole}") - F.col(f"p{whole ^ (1 << i)}") for i in range(k)]).alias("shapley"))


def steps(games: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the coalitions alone."""
    k, whole = len(letters), (1 << len(letters)) - 1
    orders = ",".join(sorted("".join(p) for p in permutations(letters)))
    out = games.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    before = F.expr("substring(filter_order, 1, step - 1)")
    out = out.withColumns({
        "i": F.instr(F.lit(letters), F.expr("substring(filter_order, step, 1)")) - 1,
        "before": sum((F.when(before.contains(c), 1 << i).otherwise(0) for i, c in enumerate(letters)), F.lit(0)),
    }).withColumn("bit", F.expr("cast(shiftleft(1, i) as int)")).withColumn("after", F.col("before") + F.col("bit"))
    lost = {c: F.expr(f"{c}[after] - {c}[before]") for c in ("removed", "good", "toxic")}
    return out.select(
        "part", "filter_order", "step", (F.col("documents") - F.expr("removed[after]")).alias("kept"), lost["removed"].alias("removed"),
        (F.expr("removed[bit]") - lost["removed"]).alias("redundant"), F.expr(f"removed[{whole}] - removed[{whole} - bit]").alias("unique_fails"),
        lost["good"].alias("good_lost"), lost["toxic"].alias("toxic_lost"), F.expr("shapley[i]").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, rules: AuditRules = AuditRules(), part_col: str = "source") -> DataFrame:
    """``steps`` of every part of the documents.

    Null texts are empty: no words, so they fail A only (and E after an equal one).
    Null parts are the part ''. Repeated rows each count, and do not make each other
    duplicates; a null doc_id is never a duplicate, has no label and makes no text a
    duplicate. A doc_id with several label rows is good (toxic) if one of them says so.
    An empty table gives an empty result. Only doc_id, text, the part column and the
    labels' three columns are read, so other columns cannot clash.
    """
    return steps(potentials(coalitions(histogram(docs, labels, rules, part_col))))


ORACLE = rf"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, regexp_extract_all(x, '{_WORD}') AS ws, min(doc_id) OVER (PARTITION BY x) AS lo FROM t),
f AS (SELECT doc_id, part, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
             100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * length(x) AS c,
             regexp_matches(x, '[#$%&*|]') AS d, coalesce(doc_id > lo, false) AS e FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
h AS (SELECT part, [a, b, c, d, e] AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
      FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
o(ord) AS (SELECT '' UNION ALL SELECT ord || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE len(ord) < 5 AND NOT contains(ord, x)),
p AS (SELECT ord, step, [instr('ABCDE', ord[i]) FOR i IN range(1, step)] AS before, instr('ABCDE', ord[step]) AS this
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE len(ord) = 5),
r AS (SELECT part, ord, step, this, n, good, toxic, fails[this] AS failing,
             len([i FOR i IN before IF fails[i]]) > 0 AS gone, len([y FOR y IN fails IF y]) AS n_fails FROM h, p),
s AS (SELECT part, ord, step, this, sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN failing AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN NOT gone AND failing AND good THEN n ELSE 0 END) AS good_lost,
             sum(CASE WHEN NOT gone AND failing AND toxic THEN n ELSE 0 END) AS toxic_lost FROM r GROUP BY ALL)
SELECT part, ord AS filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, this) AS BIGINT) AS shapley FROM s
"""
