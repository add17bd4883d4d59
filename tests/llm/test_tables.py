"""Chat formatting, WARC bundles, fingerprints and mixing: oracles, edge rows, round trips."""

import base64
import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from bidscope.llm import chat_format, fingerprints, mixing, registry, warc

from .conftest import SF, same, texts

TABLES = ("documents", "labels", "pages", "conversations")


def oracle(sql: str, **frames):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'") if t not in frames else con.register(t, frames[t])
    return con.execute(sql)


@pytest.mark.parametrize("name", sorted(registry.oracle_queries()))
def test_oracles(spark, name):
    got = registry.all_queries()[name](spark, SF)
    want = oracle(registry.oracle_queries()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    same(got.select(*columns), want.fetchall())


# Chat formatting ----------------------------------------------------------------------------------------------------
TALKS = [
    (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "user", "\\e \\\\ \\l < [ plain"),
    (2, 1, "assistant", "second \\\\l"), (2, 0, "system", " <</SYS>> <s>"), (2, 2, "tool<x> <<TEXT>>", "a <</ROLE>> b"),
    (3, 0, None, None), (3, 1, "assistant", ""), (3, 1, "assistant", ""), (4, None, "user", "no turn\n\n"), (4, 0, "assistant", "\\e"),
    (5, 0, "assistant", " </s"), (5, 1, "user", " [/INST"), (5, 2, "assistant", "é🎉 </s> x </s>"), (None, 0, "user", "nobody"), (6, 0, "user", "w " * 50_000),
]


def _digest(said: list[tuple]) -> tuple:
    loss = "".join(t for r, t in said if r == "assistant")
    return (len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_conversations_read_back(spark):
    df = spark.createDataFrame([(*t, "x") for t in TALKS], "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    talks: dict = {}
    for conv, turn, role, text in sorted(TALKS, key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        talks.setdefault(conv, []).append((role or "", text or ""))
    formatted = chat_format.format_conversations(df)
    same(chat_format.digests(formatted).drop("formatted_chars"), [(c, *_digest(t)) for c, t in talks.items()])
    rows = {r.conv_id: r for r in formatted.collect()}
    assert rows[3].formatted.startswith("<<ROLE>>")
    assert rows[5].formatted.endswith("\\eé🎉 \\l/s> x \\l/s> </s>"), "only conflicting content is escaped"
    assert chat_format.format_conversations(df.limit(0)).collect() == []


# WARC ---------------------------------------------------------------------------------------------------------------
PAGES = [(7, "http://a/x y\r\nz", "<p>é</p>"), (3, None, "<p>é</p>"), (5, "u", None), (9, "u", ""), (3, None, "<p>é</p>"), (None, "u", "<p>é</p>"),
         (None, "u", "alone"), (None, "u", "alone"), (11, "u", "big\r\n\r\n" * 90_000), (12, "u", "\r\n\r\nWARC/1.1\r\n")]


def test_archives_read_back(spark, tmp_path):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string").repartition(2)
    bundles = warc.write_archives(df, warc.Bundling(frame_bytes=200, bundle_bytes=1000))
    first: dict = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in PAGES:
        raw, f = (h or "").encode(), first.get(h or "")
        revisit = f is not None and f != i
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    same(warc.read_archives(bundles), want)
    # One record by its index entry, and the whole bundle by an ordinary decompressor.
    import zstandard

    for b in bundles.collect():
        whole = zstandard.ZstdDecompressor().decompressobj
        plain = b"".join(warc.read_frame(bytes(b.archive), e) for e in warc.seek_table(bytes(b.archive)))
        stream, out = bytes(b.archive), b""
        while stream and not stream.startswith(b"\x5e\x2a\x4d\x18"):
            d = whole()
            out += d.decompress(stream)
            stream = d.unused_data
        assert out == plain
        for r in b.records:
            fields, _ = warc.read_record(bytes(b.archive), r.frame, r.offset, r.length)
            assert fields["WARC-Record-ID"] == r.record_id
    warc.save_bundles(bundles, f"file://{tmp_path}/out")
    assert len(list((tmp_path / "out").glob("*.warc.zst"))) == bundles.count()
    assert warc.read_archives(warc.write_archives(df.limit(0))).collect() == []


def test_bundles_of_equal_rows_have_names_of_their_own(spark, tmp_path):
    df = spark.createDataFrame([(7, "u", "<p>same</p>")] * 200 + [(None, None, None)] * 200, "page_id long, url string, html string").repartition(4)
    bundles = warc.write_archives(df, warc.Bundling(frame_bytes=200, bundle_bytes=1000))
    n = bundles.count()
    assert n > 20 and bundles.select("bundle_id").distinct().count() == n
    warc.save_bundles(bundles, f"file://{tmp_path}/out")
    assert len(list((tmp_path / "out").glob("*.warc.zst"))) == n == len(list((tmp_path / "out").glob("*.json")))
    assert warc.read_archives(bundles).count() == 400


# Fingerprints -------------------------------------------------------------------------------------------------------
def _edited(rows: list[tuple]) -> list[tuple]:
    placed = sorted(r for r in rows if r[0] is not None)
    out = [(i, t, placed[(k + 1) % len(placed)][1]) for k, (i, t) in enumerate(placed)] + [(None, t, None) for i, t in rows if i is None]
    cut = lambda t, n: t[: len(t) - len(t) // 2] + (n or "")[: len(t) // 2]
    return [(i, len(t), hashlib.sha256(cut(t, n).encode()).hexdigest()) for i, t, n in out]


@pytest.mark.parametrize("name", ["edge", "documents"])
def test_edited_texts(request, name):
    docs = request.getfixturevalue(name)
    got = fingerprints.fingerprints(docs)
    same(got.select("doc_id", "n_chars", "edited_sha256"), _edited(texts(docs)))
    rows = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    by_text: dict = {}
    for i, t in texts(docs):
        if i is not None:
            assert by_text.setdefault(t, rows[i].fingerprint) == rows[i].fingerprint
    unhex = lambda s: np.frombuffer(bytes.fromhex(s), ">u2").astype(np.uint16)
    order = sorted(rows)
    for i, j in zip(order, order[1:]):
        r = rows[i]
        assert r.near_edited == pytest.approx(float(fingerprints.likeness(unhex(r.fingerprint), unhex(r.edited_fingerprint))))
        assert r.near_next == pytest.approx(float(fingerprints.likeness(unhex(r.fingerprint), unhex(rows[j].fingerprint))))
    if name == "documents":
        longer = [r for r in rows.values() if r.n_chars > 1000]
        assert np.mean([r.near_edited for r in longer]) > 0.25 > 0.05 > np.mean([r.near_next for r in longer])


def test_phrases_do_not_depend_on_the_offset():
    rng = np.random.default_rng(3)
    body = rng.integers(97, 110, 3000).astype(np.uint8)

    def names(prefix: bytes, level: int) -> set:
        buf = np.concatenate((np.frombuffer(prefix, np.uint8), body))
        head = np.zeros(len(buf), bool)
        head[0] = True
        out = fingerprints._SYMBOL[buf]
        for k in range(1, level + 1):
            out, head = fingerprints._squeeze(out, head)
            begins = fingerprints._landmarks(out, head)
            assert np.diff(begins).max() <= 14 and np.diff(begins)[1:].min() >= 2
            out, head = fingerprints._names(out, begins, k), head[begins]
        return set(out.tolist())

    for level in (1, 2, 3):
        a, b = names(b"", level), names(b"some other beginning aaaaaaaaaaaa", level)
        assert len(a & b) >= len(a) - 8


def test_fingerprints_of_few_rows(spark, empty):
    assert fingerprints.fingerprints(empty).collect() == []
    one = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    same(fingerprints.fingerprints(one).select("doc_id", "edited_sha256", "near_next"), [(5, hashlib.sha256(b"abcabc").hexdigest(), 1.0)])


# Mixing -------------------------------------------------------------------------------------------------------------
def test_mix_of_edge_rows(edge, empty):
    rows = [(i, t, s) for i, t, s in ((r.doc_id, r.text, r.source) for r in edge.collect())]
    import pandas as pd

    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    got = mixing.mix_documents(edge)
    same(got.select("doc_id", "size", "source_size", "target", "taken"), oracle(mixing.ORACLE, documents=frame).fetchall())
    again = mixing.mix_documents(edge.repartition(2))
    same(again, list(map(tuple, got.collect())))
    assert mixing.mix_documents(empty).collect() == []


def test_mix_meets_its_targets(documents):
    rows = mixing.mix_documents(documents.withColumn("size", F.lit(1)), keep=("source",)).collect()
    assert all(r.taken <= 2 * r["size"] for r in rows)
    sources: dict = {}
    for r in rows:
        s = sources.setdefault(r.source, [r.target, 0, r.source_size])
        s[1] += r.taken
    for target, taken, size in sources.values():
        assert abs(taken - target) <= 0.01 * target + 4 * mixing.Mix().block_words and target <= 2 * size
    assert sum(t for t, _, _ in sources.values()) == pytest.approx(1.5 * sum(s for _, _, s in sources.values()))
