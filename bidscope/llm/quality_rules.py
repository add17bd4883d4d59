"""Host-level quality rules.

1. Every whole text is measured once: words, symbols, repeated lines, words in
   repeated 3-word windows.
2. Each document fails or passes a set of soft rules over these counts.
3. Rule failures are summed by host. A host's raw failure rate is shrunk towards
   all hosts' by a beta prior fitted to the host rates by moments, so a host of a
   few documents is not judged on chance.
4. A rule binds on the hosts whose shrunk rate reaches ``max_rate``. The verdicts
   are joined back: a document is rejected if it fails the base rules, or a soft
   rule that binds on its host. A document that fails no rule is always kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .scratch import materialise, ship

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class HostRules:
    """Thresholds in percent of words or lines; ``max_rate``: a host's shrunk rate from which a rule binds."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_symbol_pct: int = 10
    max_dup_line_pct: int = 30
    min_mean_chars: int = 2
    max_mean_chars: int = 15
    soft_repeat_pct: int = 20
    max_rate: float = 0.25
    salts: int = 16

    def base_failed(self) -> Column:
        n = F.col("n_words")
        return (n < self.min_words) | (100 * F.col("n_repeat_words") > self.max_repeat_pct * n)

    def soft(self) -> dict[str, Column]:
        n = F.col("n_words")
        return {
            "symbols": 100 * F.col("n_symbols") > self.max_symbol_pct * n,
            "dup_lines": 100 * F.col("n_dup_lines") > self.max_dup_line_pct * F.col("n_lines"),
            "word_length": (F.col("word_chars") < self.min_mean_chars * n) | (F.col("word_chars") > self.max_mean_chars * n),
            "repeats": 100 * F.col("n_repeat_words") > self.soft_repeat_pct * n,
        }


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: is it found twice or more; is it a later one."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]] if len(keys) > 1 else False
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order] = same[:-1]
    twice[order] = same[:-1] | same[1:]
    return twice, later


def _measure(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    texts = np.arange(len(offsets) - 1)
    starts, ends, first = tn.spans(buf, offsets, tn.SPACE_WORD)
    points = tn.chars(buf)
    grams, begin = tn.windows(tn.span_hash(buf, starts, ends), first, 3)
    owner = np.repeat(texts, np.diff(begin))
    twice, _ = _again(tn.mix64(grams + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    covered = np.zeros(len(starts), bool)
    at = np.flatnonzero(twice)
    at = at - begin[owner[at]] + first[owner[at]]
    for k in range(3):
        covered[at + k] = True

    member = np.ones(256, bool)
    member[0x0A] = False
    l_starts, l_ends, _ = tn.spans(buf, offsets, member)
    worded = np.searchsorted(starts, l_ends) > np.searchsorted(starts, l_starts)
    l_starts, l_ends = l_starts[worded], l_ends[worded]
    l_first = np.searchsorted(l_starts, offsets)
    l_owner = np.repeat(texts, np.diff(l_first))
    _, later = _again(tn.mix64(tn.span_hash(buf, l_starts, l_ends) + l_owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return {
        "n_words": np.diff(first),
        "word_chars": _per_text(points[ends] - points[starts], first),
        "n_symbols": _per_text(_SYMBOL[buf], offsets),
        "n_dup_lines": _per_text(later, l_first),
        "n_lines": np.diff(l_first),
        "n_repeat_words": _per_text(covered, first),
    }


def measure(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` (the text may be one of them) and the six counts of each row's whole text (null text: none)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in tn.pieces(batch.column("text")):
                counts = _measure(buf, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(lo, hi - lo) for k in keys] + [pa.array(counts[m], pa.int64()) for m in MEASURES],
                    [*keys, *MEASURES],
                )

    ship(docs.sparkSession)
    narrow = docs.select(*[k for k in keys if k != "text"], F.col("text").cast("string").alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    fields = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    return narrow.mapInArrow(run, f"{fields}, " + ", ".join(f"{m} long" for m in MEASURES))


def host_rates(measured: DataFrame, rules: HostRules) -> DataFrame:
    """host, n, and for each soft rule its failures, shrunk rate and whether it binds; one row a host."""
    soft = rules.soft()
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.when(c, 1).otherwise(0)).alias(f"f_{r}") for r, c in soft.items()]
    )
    # One row of moments, whatever the number of hosts.
    raw = {r: F.col(f"f_{r}") / F.col("n") for r in soft}
    moments = hosts.agg(F.struct(*[F.avg(raw[r]).alias(f"m_{r}") for r in soft], *[F.var_pop(raw[r]).alias(f"v_{r}") for r in soft]).alias("x")).first().x
    for r in soft:
        m, v = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        # Documents that the prior is worth; hosts all alike: the prior outweighs every host.
        weight = max(m * (1 - m) / v - 1, 1.0) if v > 0 else 1e12
        rate = (F.col(f"f_{r}") + m * weight) / (F.col("n") + weight)
        hosts = hosts.withColumn(f"rate_{r}", rate).withColumn(f"binds_{r}", rate >= rules.max_rate)
    return hosts


def _counted(docs: DataFrame, host_col: str, keep: list[str]) -> DataFrame:
    """Counts of every row under doc_id, host and the columns ``keep``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col(host_col).cast("string").alias("host"), F.col("text").cast("string"), *keep)
    return measure(rows, ["doc_id", "host", *keep])


def _judged(counted: DataFrame, verdicts: DataFrame, rules: HostRules) -> DataFrame:
    """The counted rows with base_failed and kept, their hosts' verdicts joined in ``salts`` parts."""
    parts = verdicts.select("host", *[f"binds_{r}" for r in rules.soft()], F.explode(F.sequence(F.lit(0), F.lit(rules.salts - 1))).alias("salt"))
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(rules.salts)).cast("int"))
    same = F.col("d.host").eqNullSafe(F.col("v.host")) & (F.col("d.salt") == F.col("v.salt"))
    joined = salted.alias("d").join(parts.alias("v"), same, "left").select("d.*", *[f"v.binds_{r}" for r in rules.soft()])
    bound = F.lit(False)
    for r, failed in rules.soft().items():
        bound = bound | (failed & F.coalesce(F.col(f"binds_{r}"), F.lit(False)))
    base = rules.base_failed()
    return joined.withColumns({"base_failed": base, "kept": ~base & ~bound})


def judge(docs: DataFrame, rules: HostRules = HostRules(), host_col: str = "source") -> DataFrame:
    """doc_id, the counts, base_failed and kept, one row for each input row.

    Null or empty text: no words, so it fails the base rules. Null hosts form one
    host of their own. Repeated rows count and are judged each. A null doc_id is
    kept. An empty table gives an empty result. Only doc_id, text and the host
    column are read, so other columns cannot clash. A hot host is summed map-side
    and its documents meet its verdict in ``salts`` parts.
    """
    counted = materialise(_counted(docs, host_col, []), "quality")
    judged = _judged(counted, host_rates(counted, rules), rules)
    return judged.select("doc_id", *[m for m in MEASURES if m != "n_lines"], "base_failed", "kept")


def good_documents(docs: DataFrame, rules: HostRules = HostRules(), host_col: str = "source") -> DataFrame:
    """The rows that ``judge`` keeps, with the columns of ``docs``; each row by its own text.

    Nulls, empty texts, repeated rows and other columns as in ``judge``. A text goes to Python once, beside
    the row's other columns under names of their own, and is judged where it comes back.
    """
    verdicts = materialise(host_rates(materialise(_counted(docs, host_col, []), "quality"), rules), "quality-hosts")
    names = {c: f"column_{i}" for i, c in enumerate(docs.columns) if c != "text"}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col("text").cast("string").alias("text"),
                       *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    kept = _judged(measure(rows, ["doc_id", "host", "text", *names.values()]), verdicts, rules).filter("kept")
    return kept.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


_WORD = r"[^\x20\x09-\x0D]+"

ORACLE = f"""
WITH t AS (SELECT doc_id, source AS host, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS ws FROM t),
win AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid),
ln AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
       FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM t) WHERE regexp_matches(l, '{_WORD}') GROUP BY rid),
c AS (SELECT doc_id, host, rid, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM w LEFT JOIN ln USING (rid) LEFT JOIN rep USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             100 * n_symbols > 10 * n_words AS s1, 100 * n_dup_lines > 30 * n_lines AS s2,
             word_chars < 2 * n_words OR word_chars > 15 * n_words AS s3, 100 * n_repeat_words > 20 * n_words AS s4 FROM c),
h AS (SELECT host, count(*) AS n, count_if(s1) AS f1, count_if(s2) AS f2, count_if(s3) AS f3, count_if(s4) AS f4 FROM f GROUP BY host),
r AS (SELECT host, n, unnest([f1, f2, f3, f4]) AS k, unnest([1, 2, 3, 4]) AS rule FROM h),
p AS (SELECT rule, avg(k / n) AS m, var_pop(k / n) AS v FROM r GROUP BY rule),
q AS (SELECT rule, m, CASE WHEN v > 0 THEN greatest(m * (1 - m) / v - 1, 1.0) ELSE 1e12 END AS wt FROM p),
b AS (SELECT host, max(CASE WHEN rule = 1 THEN hit END) AS b1, max(CASE WHEN rule = 2 THEN hit END) AS b2,
             max(CASE WHEN rule = 3 THEN hit END) AS b3, max(CASE WHEN rule = 4 THEN hit END) AS b4
      FROM (SELECT host, rule, CAST((k + m * wt) / (n + wt) >= 0.25 AS INT) AS hit FROM r JOIN q USING (rule)) GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (s1 AND b1 = 1 OR s2 AND b2 = 1 OR s3 AND b3 = 1 OR s4 AND b4 = 1) AS kept
FROM f JOIN b ON f.host IS NOT DISTINCT FROM b.host
"""
