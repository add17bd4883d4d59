"""Filter audit, embedding forest and spelling variants against brute force, with edge rows."""

import math
import re
import zlib
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from bidscope.llm import embedding_forest as ef
from bidscope.llm import filter_audit as fa
from bidscope.llm import spelling_variants as sv
from tests.llm.conftest import SF, same


# ---- filter audit -------------------------------------------------------------------------------------------------

def _brute_audit(docs: list[tuple], labels: list[tuple]) -> list[tuple]:
    """Every order applied to every document, filter after filter; docs are (doc_id, text, source)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, source in docs:
        x = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", x)
        smaller = any(j is not None and i is not None and j < i and (y or "") == x for j, y, _ in docs)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in x) > 5 * len(x),
                 "D": any(c in "#$%&*|" for c in x), "E": smaller}
        rows.append((source or "", fails, i in good, i in toxic))
    out, total = [], Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if r[1][letter]]
                kept = [r for r in left if not r[1][letter]]
                failing = [r for r in rows if r[0] == part and r[1][letter]]
                out.append([part, "".join(order), step, len(kept), len(gone), len(failing) - len(gone),
                            sum(sum(r[1].values()) == 1 for r in failing), sum(r[2] for r in gone), sum(r[3] for r in gone)])
                total[part, letter] += len(gone)
                left = kept
    return [(*r, total[r[0], r[1][r[2] - 1]]) for r in out]


def test_audit_of_edge_rows(spark, edge):
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (3, None, 1), (8, 1, None), (None, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("clash"))
    docs = [(r.doc_id, r.text, r.source) for r in edge.collect()]
    same(fa.audit(edge, frame), _brute_audit(docs, labels))


def test_audit_of_duplicates_and_ties(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = [(5, long, "a"), (5, long, "b"), (7, long, "b"), (7, long, "b"), (None, long, "a"), (3, long + "!", "a"), (9, "SHOUT " * 60, "b"), (9, None, None), (11, "", "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    labels = spark.createDataFrame([(7, 1, 1)], "doc_id long, quality int, toxic int")
    same(fa.audit(frame, labels), _brute_audit(docs, [(7, 1, 1)]))


def test_audit_of_nothing(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.audit(empty, labels).collect() == []


def test_audit_sql(spark, documents):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = fa.audit(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    same(got, con.sql(f"SELECT {', '.join(got.columns)} FROM ({fa.ORACLE})").fetchall())


def test_potentials_of_any_game(spark):
    """Potentials against the closed formula, Shapley values against all orders, on a random game of four players."""
    k, rng = 4, np.random.default_rng(1)
    counts = [("p", int(m), bool(g), False, int(n)) for m, g, n in zip(range(16), rng.integers(0, 2, 16), rng.integers(0, 50, 16))]
    frame = spark.createDataFrame(counts, "part string, mask int, good boolean, toxic boolean, n long")
    row = fa.potentials(fa.coalitions(frame, k), k).first()
    v = [sum(n for _, m, _, _, n in counts if m & s) for s in range(16)]
    assert list(row.removed) == v
    for s in range(1, 16):
        size = s.bit_count()
        closed = sum(math.factorial(t.bit_count() - 1) * math.factorial(size - t.bit_count()) * v[t] for t in range(1, 16) if t & s == t)
        assert row.potential[s] * math.factorial(size) == closed * math.factorial(k)
    for i in range(k):
        shares = 0
        for order in permutations(range(k)):
            before = sum(1 << j for j in order[:order.index(i)])
            shares += v[before | 1 << i] - v[before]
        assert row.shapley[i] == shares


# ---- embedding forest ---------------------------------------------------------------------------------------------

def _links(rows: list[tuple], threshold: float = 0.93) -> dict[int, set[int]]:
    """Positions of linked rows, each pair compared by itself; rows are (vec_id, vector, label)."""
    good = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = [np.array(v, float) / np.abs(np.array(v, float)).max() if good(v) and la is not None else None for _, v, la in rows]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    out: dict[int, set[int]] = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                out[i].add(j)
                out[j].add(i)
    return out


def _brute_forest(rows: list[tuple]) -> list[tuple]:
    links, out = _links(rows), []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, len(links[i]), least, vec_id == least))
    return out


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"kept": F.lit("clash"), "cls": F.lit(-1)}).repartition(3)


def test_forest_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
            (6, [0.0, 0.0], 1), (7, [0.0, -0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [], 1), (12, [1.0], 1),
            (None, [0.0, 2.0], 1), (None, [-1.0, 0.0], 1), (None, None, None), (13, [1e300, 1e-300], 1), (14, [5e-324, 0.0], 1), (15, [1.0, 0.3952], 1), (16, [1.0, 0.3953], 1)]
    same(ef.near_duplicates(_vectors(spark, rows)), _brute_forest(rows))


def test_forest_of_nothing(spark):
    assert ef.near_duplicates(_vectors(spark, [(1, [1.0], 1)]).limit(0)).collect() == []


def test_forest_of_the_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    same(ef.near_duplicates(df), _brute_forest(rows))


@pytest.fixture(scope="module")
def families():
    """Random vectors, pairs just above the threshold, one family of near copies, one vector many times."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((900, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    close = []
    for b in base[:300]:
        n = rng.standard_normal(32)
        n -= (n @ b) * b
        c = rng.uniform(0.9305, 0.95)
        close.append(c * b + math.sqrt(1 - c * c) * n / np.linalg.norm(n))
    family = base[0] + 0.02 * rng.standard_normal((200, 32))
    copies = np.repeat(base[5:6], 150, axis=0)
    everything = np.concatenate([base, np.array(close), family, copies])
    return [(int(i), v.tolist(), 1) for i, v in zip(rng.permutation(len(everything)), everything)]


def test_forest_recall_when_nodes_are_split(spark, families):
    """Deep trees of small leaves in two rounds and more: no pair too many, and nearly all of the hard ones found."""
    forest = ef.Forest(leaf=40, sample=500, cell=64, levels=2)
    got = {r.vec_id: r for r in ef.near_duplicates(_vectors(spark, families), forest).collect()}
    links = _links(families)
    assert len(got) == len(families)
    total = sum(map(len, links.values()))
    found = sum(r.n_links for r in got.values())
    assert 0.99 * total <= found <= total
    assert all(got[families[i][0]].n_links <= len(near) for i, near in links.items())


def test_forest_pairs_count_once(spark, families):
    """The links of every point are those of brute force over exactly the pairs that share a leaf."""
    forest = ef.Forest(leaf=40, sample=500, cell=64, trees=3)
    points = ef.materialise(ef.numbered(_vectors(spark, families[:1400])).select(F.col("vec_id").alias("cls"), "part", "vec", F.lit(1).cast("long").alias("copies")), "test")
    placed = ef.leaves(points, forest)
    shared: dict = {}
    for r in placed.collect():
        shared.setdefault(r.cls, set()).add((r.tree, r.node))
    assert max(len({n for t, n in v if t == 0}) for v in shared.values()) > 1
    ids = [f[0] for f in families]
    want = {ids[i]: sum(bool(shared[ids[i]] & shared[ids[j]]) for j in near) for i, near in _links(families[:1400]).items()}
    got = {r.cls: r.n for r in ef.links(points, placed, forest).groupBy("cls").agg(F.sum("links").alias("n")).collect()}
    assert got == {i: n for i, n in want.items() if n}


def test_local_roots():
    rng = np.random.default_rng(2)
    m = rng.random((60, 60)) < 0.02
    m |= m.T
    root = ef.local_roots(m)
    for i in range(60):
        seen, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(m[todo.pop()]).tolist():
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert root[i] == min(seen)


# ---- spelling variants --------------------------------------------------------------------------------------------

def _near(w: str, words) -> list[str]:
    letters = [chr(c) for c in [*range(0x61, 0x7B), *range(0xC0, 0x100)]]
    edits = {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
    edits |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters} | {w[:i] + w[i + 1:] for i in range(len(w))}
    return [e for e in edits - {w} if e in words]


def _brute_variants(docs: list[tuple]) -> list[tuple]:
    seen, down = Counter(), {i: i + 32 for i in range(65, 91)}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(down)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    words = {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}
    near = {w: _near(w, words) for w in words}
    form = {}
    for w, others in near.items():
        best = min(((-words[x], x) for x in others), default=None)
        form[w] = best[1] if best and -best[0] >= 10 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def test_spelling_of_the_tables(spark, documents):
    same(sv.variants(documents), _brute_variants([(r.doc_id, r.text) for r in documents.collect()]))


def test_spelling_edge_rows(spark, edge):
    same(sv.variants(edge), _brute_variants([(r.doc_id, r.text) for r in edge.collect()]))
    assert sv.variants(edge.limit(0)).collect() == []


def _spelled(spark, words: dict[str, int]):
    return spark.createDataFrame([(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())], "doc_id long, text string").withColumns(
        {"word": F.lit("clash"), "n": F.lit("clash")}).repartition(3)


def test_spelling_chains_ties_and_accents(spark):
    """Chains of forms, equal counts, swapped letters (two edits), accents, an insertion into a run of one letter."""
    words = {"letterx": 2, "lettery": 20, "letters": 20, "letterss": 300, "elttery": 2, "français": 50, "francais": 5, "aaaaaaaa": 40, "aaaaaaa": 4,
             "ÉÀÇÙÊÎÔ": 3, "éàçùêîô": 3, "q" * 3000: 2, "q" * 2999: 2, "q" * 2999 + "z": 30}
    docs = _spelled(spark, words)
    same(sv.variants(docs), _brute_variants([(r.doc_id, r.text) for r in docs.collect()]))


def test_spelling_of_crowded_blocks(spark):
    """Small blocks, so that words of one length and key are dealt over cells of many rows."""
    rng = np.random.default_rng(3)
    letters = np.array(list("abc"))
    words = {"".join(rng.choice(letters, int(n))): int(c) for n, c in zip(rng.integers(7, 10, 1500), rng.integers(2, 60, 1500))}
    docs = _spelled(spark, words)
    same(sv.variants(docs, sv.Spelling(bucket=16, cell=20)), _brute_variants([(r.doc_id, r.text) for r in docs.collect()]))


def test_one_edit():
    rng = np.random.default_rng(4)
    for n, m in ((7, 7), (7, 8)):
        a = ["".join(rng.choice(list("ab"), n)) for _ in range(400)]
        b = ["".join(rng.choice(list("ab"), m)) for _ in range(400)]
        want = [x != y and x in {y[:i] + c + y[i + 1:] for i in range(m) for c in (["a", "b"] if n == m else [""])} for x, y in zip(a, b)]
        assert sv.one_edit(a, b).tolist() == want
