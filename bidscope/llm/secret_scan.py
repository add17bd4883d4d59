"""Secret scan with multipart credential linking.

Strong spans stand alone: assignments of passwords, tokens and keys, access
identifiers, long hexadecimal strings. Weak parts are reported only if the parts
that complete them lie within ``scope`` code points in the same text:

* ``identity`` (a user or account assignment): next to a secret,
* ``material`` (a long mixed string that no strong span covers): next to an
  access identifier or an identity,
* ``endpoint`` (a URL): next to both an identifier and a secret.

The parts of all documents become rows (document, bin of ``scope`` code points,
kind, start, end), and weak parts meet strong ones and each other in left-semi
interval joins on document and bin, so no list of pairs is ever made.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .scratch import materialise, ship

# Kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "identity", "material", "endpoint")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_IDENTITY = re.compile(r"""\b(?:user(?:name)?|login|account|client_id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""", re.I | re.A)
_MATERIAL = re.compile(r"[A-Za-z0-9+/_=-]{32,}")
_ENDPOINT = re.compile(r"https?://[A-Za-z0-9.:-]+", re.I | re.A)
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_NAMES = (b"user", b"login", b"account", b"client_id")
_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True
_MIXED_BYTE = np.zeros(256, bool)
_MIXED_BYTE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True

PART = "struct<start:long,rank:int,end:long>"
SCHEMA = f"doc_id long, rid long, n_assign long, n_access long, n_hex long, base_sha256 string, base array<{PART}>, weak array<{PART}>"


@dataclass(frozen=True)
class Linking:
    """``scope``: the distance in code points within which parts complete each other."""

    scope: int = 200


def _strong(text: str, low: bytes, long_hex: bool) -> list[tuple[int, int, int]]:
    found = []
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"akia" in low:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if long_hex:
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _weak(text: str, low: bytes, long_mixed: bool, strong: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak parts outside the strong spans; none unless the text has two kinds of parts."""
    found = [(m.start(), 3, m.end()) for m in _IDENTITY.finditer(text)] if any(k in low for k in _NAMES) else []
    if not found and not strong:
        return []
    if long_mixed:
        found += [(m.start(), 4, m.end()) for m in _MATERIAL.finditer(text) if any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0])]
    if b"://" in low:
        found += [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)]
    if not found:
        return []
    ends = np.array([e for _, _, e in strong] or [-1])
    starts = np.array([s for s, _, _ in strong] or [1 << 62])
    return sorted(w for w in found if not ((starts < w[2]) & (ends > w[0])).any())


def parts(docs: DataFrame) -> DataFrame:
    """Strong spans, counts and digest, and weak candidates of each row's whole text; ``rid`` numbers the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            rows: list[tuple] = []
            for lo, hi, buf, offsets in tn.pieces(texts):
                long_run = []
                for member, least in ((_HEX_BYTE, 24), (_MIXED_BYTE, 32)):
                    starts, ends, first = tn.spans(buf, offsets, member)
                    long_run.append(np.add.reduceat(np.append(ends - starts >= least, False), first[:-1]) * (np.diff(first) > 0))
                data = buf.tobytes()
                for i in range(hi - lo):
                    raw = data[offsets[i] : offsets[i + 1]]
                    low = raw.lower()
                    text = raw.decode()
                    strong = _strong(text, low, bool(long_run[0][i]))
                    weak = _weak(text, low, bool(long_run[1][i]), strong)
                    listed = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in strong)
                    counts = [sum(k == j for _, k, _ in strong) for j in range(3)]
                    rows.append((*counts, hashlib.sha256(listed.encode()).hexdigest(), strong, weak))
            as_parts = lambda spans: [{"start": s, "rank": k, "end": e} for s, k, e in spans]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rid"), *[pa.array([r[j] for r in rows], pa.int64()) for j in range(3)],
                 pa.array([r[3] for r in rows], pa.string()), pa.array([as_parts(r[4]) for r in rows], kind), pa.array([as_parts(r[5]) for r in rows], kind)],
                ["doc_id", "rid", "n_assign", "n_access", "n_hex", "base_sha256", "base", "weak"],
            )

    ship(docs.sparkSession)
    return (
        docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
        .withColumn("rid", F.monotonically_increasing_id())
        .mapInArrow(run, SCHEMA)
    )


def linked(found: DataFrame, linking: Linking) -> DataFrame:
    """rid, start, rank, end of the weak parts that complementary parts complete."""
    scope = linking.scope

    def rows(column: str) -> DataFrame:
        return found.filter(F.size("weak") > 0).select("rid", F.explode(column).alias("p")).select("rid", "p.start", "p.rank", "p.end")

    weak, strong = rows("weak"), rows("base")

    def near(part: DataFrame, other: DataFrame) -> DataFrame:
        """Parts with another one at most ``scope`` code points away: each meets the bins that its reach touches."""
        reach = F.explode(F.sequence(F.floor(F.greatest(F.col("start") - scope, F.lit(0)) / scope), F.floor((F.col("end") + scope) / scope)))
        bins = F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope)))
        a, b = part.withColumn("bin", reach).alias("a"), other.withColumn("bin", bins).alias("b")
        close: Column = (
            (F.col("a.rid") == F.col("b.rid")) & (F.col("a.bin") == F.col("b.bin"))
            & (F.col("b.start") <= F.col("a.end") + scope) & (F.col("b.end") >= F.col("a.start") - scope)
        )
        return a.join(b, close, "left_semi").select("rid", "start", "rank", "end").distinct()

    access, secret = strong.filter("rank = 1"), strong.filter("rank in (0, 2)")
    identity = weak.filter("rank = 3")
    identifier = access.unionByName(identity)
    material = near(weak.filter("rank = 4"), identifier)
    any_secret = secret.unionByName(material)
    return near(identity, any_secret).unionByName(material).unionByName(near(near(weak.filter("rank = 5"), identifier), any_secret))


def secret_scan(docs: DataFrame, linking: Linking = Linking()) -> DataFrame:
    """Counts, digest and spans of the secrets in every row's whole text.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256 (strong spans) and spans
    (all, as kind:start:end by start, then kind; code points, end exclusive). Null
    or empty text: no spans, the digest of the empty string. Repeated rows give a
    row each, a null doc_id is kept, an empty table gives an empty result, and
    other columns are not read.
    """
    found = materialise(parts(docs), "secrets")
    extra = linked(found, linking).groupBy("rid").agg(F.collect_list(F.struct("start", "rank", "end")).alias("extra"))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.array_sort(F.concat("base", F.coalesce("extra", F.expr(f"cast(array() as array<{PART}>)"))))
    text = F.transform(spans, lambda p: F.concat_ws(":", F.get(names, p["rank"]), p["start"].cast("string"), p["end"].cast("string")))
    return found.join(extra, "rid", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.concat_ws(",", text).alias("spans")
    )
