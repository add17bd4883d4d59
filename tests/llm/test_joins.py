"""Similarity joins, components and the pipeline against brute force."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from bidscope.llm import components, line_dedup, mixing, ngram_join, quality_rules, registry, setjoin

from .conftest import SF, same, texts

BLANK = b" \t\n\r\x0b\x0c"


def similar_sets(sets: list, num: int, den: int):
    """(later, earlier) index pairs of sets with Jaccard similarity num/den or more, by counting all shared tokens."""
    inverted = defaultdict(list)
    for j, s in enumerate(sets):
        for q, n in Counter(q for w in s for q in inverted[w]).items():
            if n * den >= num * (len(s) + len(sets[q]) - n):
                yield j, q
        for w in s:
            inverted[w].append(j)


def lines_brute(rows, min_words=1):
    """(doc_id, text that stays, lines, removed) of rows (doc_id, text); rows of one id in order of their texts' digests, null ids last."""
    seen = []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, hashlib.sha256((rows[i][1] or "").encode()).hexdigest(), i))
    rank = {i: r for r, i in enumerate(order)}
    for i, (d, t) in enumerate(rows):
        for k, line in enumerate(t.split("\n") if t else []):
            words = line.encode().split()
            if len(words) >= min_words:
                seen.append(((rank[i], k), frozenset(words), i))
    first: dict = {}
    for place, s, _ in seen:
        first[s] = min(first.get(s, place), place)
    sets = sorted(first, key=first.get)
    gone = {sets[j] for j, _ in similar_sets(sets, 4, 5)}
    drop = defaultdict(set)
    for place, s, i in seen:
        if s in gone or place != first[s]:
            drop[i].add(place[1])
    out = []
    for i, (d, t) in enumerate(rows):
        lines = t.split("\n") if t else []
        left = [x for k, x in enumerate(lines) if k not in drop[i]]
        kept = t or ""
        if drop[i]:
            kept = "\n".join(left) if any(x.encode().strip(BLANK) for x in left) else ""
        out.append((d, kept, len(lines), len(drop[i])))
    return out


def components_brute(rows, width=4, num=17, den=20):
    """(doc_id, set size, component) of rows (doc_id, text)."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    known: dict = {}
    for i, ((d, _), s) in enumerate(zip(rows, sets)):
        for k in ([("id", d)] if d is not None else []) + ([("set", s)] if s and d is not None else []):
            parent[find(i)] = find(known.setdefault(k, i))
    linked = [i for i, (d, _) in enumerate(rows) if d is not None]
    for a, b in similar_sets([sets[i] for i in linked], num, den):
        parent[find(linked[a])] = find(linked[b])
    low: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(sets[i]), None if d is None else low[find(i)]) for i, (d, _) in enumerate(rows)]


def family(seed=1, n=40):
    """Families of near copies with drifting edits, shared passages, copies, repeated ids and edge rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    rows = []
    for f in range(4):
        base = [rng.choice(vocabulary) for _ in range(120)]
        for k in range(n):
            if k % 5 == 0:
                base[rng.randrange(120)] = rng.choice(vocabulary)  # the family drifts
            text = list(base)
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(120)] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text[:20]) + "\n" + " ".join(text[20:]) + ("\n" + passage if k % 3 == 0 else "")))
    rows += [(1000 + i, rows[i][1]) for i in range(0, 60, 7)]
    rows += [(5, "another text of the same document id with more words"), (6, rows[90][1]), (2000, None), (2001, ""), (2002, "One two"), (2003, "one TWO"),
             (None, rows[0][1]), (None, rows[0][1]), (2004, " \n\n "), (2005, "a b c d e"), (2006, "e d c b a"), (2007, "x " * 2000)]
    return rows


@pytest.fixture(scope="module")
def families(spark):
    rows = family()
    return rows, spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, id int").repartition(3)


@pytest.mark.parametrize("tries, cell", [(2, 20_000), (1, 20_000), (1, 7)])
def test_ngram_families(families, tries, cell):
    rows, df = families
    join = ngram_join.NgramJoin(tries=tries, cell=cell)
    want = components_brute(rows)
    assert 5 < len({c for _, n, c in want if n > 10}) < 100
    same(ngram_join.ngram_components(df, join), want)


def test_ngram_documents(documents):
    same(ngram_join.ngram_components(documents), components_brute(texts(documents)))


@pytest.mark.parametrize("tries, cell", [(3, 20_000), (1, 7)])
def test_line_families(families, tries, cell):
    rows, df = families
    got = line_dedup.dedup_lines(df, line_dedup.LineJoin(tries=tries, cell=cell), keep=("id",))
    want = lines_brute(rows)
    assert sum(r[3] for r in want) > 100
    same(got.selectExpr("doc_id", "coalesce(text, '')", "n_lines", "n_removed"), want)


def test_line_documents(documents, edge):
    for df in (documents, edge):
        same(line_dedup.dedup_lines(df).selectExpr("doc_id", "coalesce(text, '')", "n_lines", "n_removed"), lines_brute(texts(df)))


def test_joins_of_nothing(empty):
    assert ngram_join.ngram_components(empty).collect() == []
    assert line_dedup.dedup_lines(empty).collect() == []


def test_edge_components(edge):
    same(ngram_join.ngram_components(edge), components_brute(texts(edge)))


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(50)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    alone = {x for e in edges for x in e} - {x for a, b in edges if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(edges, "u long, v long"))
    same(got, [(x, find(x)) for x in parent if x not in alone])


def test_pipeline(spark):
    """All five stages in plain Python and SQL."""
    import public_tokenizers
    import sentencepiece

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality_rules.ORACLE}) WHERE kept").fetchall()}
    rows = [r for r in con.execute("SELECT doc_id, text, source FROM documents").fetchall() if r[0] in kept]
    source = {r[0]: r[2] for r in rows}
    rows = [(d, t) for d, t, _, out in lines_brute([r[:2] for r in rows]) if not out or t]
    low = {d: c for d, _, c in components_brute(rows, width=5, num=4, den=5)}
    rows = [(d, t) for d, t in rows if low[d] == d]
    import pandas as pd

    con.register("left_over", pd.DataFrame([(d, t, source[d]) for d, t in rows], columns=["doc_id", "text", "source"]))
    taken = con.execute(mixing.ORACLE.replace("FROM documents", "FROM left_over")).fetchall()
    times = {r[0]: int(r[4] / max(r[1], 1) + 0.5) for r in taken}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t in rows:
        ids = sp.encode(t)
        want += [(d, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))] * times[d]
    assert 100 < len(want) < 500
    same(corpus_pipeline.run(spark, SF), want)


def test_stages_take_edge_rows(spark, edge):
    docs = edge.select(*corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        out.collect()
        assert stage(spark, docs.limit(0), SF).collect() == []
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()].count(1) == 1


def test_fraction_thresholds_are_exact():
    assert ngram_join.NgramJoin().similarity == Fraction(17, 20) and line_dedup.LineJoin().similarity == Fraction(4, 5)


def test_no_set_is_its_own_match(spark):
    """Two prefix words with the same 32 bits put a set twice in one list."""
    twice = [(1, 0, -1, 7, 10, 0, 3, 5), (1, 0, -1, 7, 10, 1, 3, 5), (1, 0, -1, 9, 10, 0, 3, 5)]
    listed = spark.createDataFrame(twice, setjoin.SIGNED)
    same(setjoin.first_candidates(listed, Fraction(4, 5), setjoin.SIGNED).filter("a is not null").select("a", "b"), [(7, 9)])
    tagged = spark.createDataFrame([(*p, 0) for p in twice], f"{setjoin.SIGNED}, tag long")
    same(setjoin.open_candidates(tagged, Fraction(4, 5), setjoin.SIGNED), [(7, 9)])


def short_lines(seed=4):
    """Lines of 1 to 6 words from a few, in their own texts: equal sets, 4 words that meet 5, pairs just below the threshold."""
    rng = random.Random(seed)
    rows = [(i, "\n".join(" ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 6))) for _ in range(6))) for i in range(30)]
    return rows + [(100, "p q r s"), (101, "p q r s t"), (102, "s r q p"), (103, "Les."), (104, "Les.\n\nOf, oner. edti"), (105, "oner. Of, edti"), (106, "u v w"), (107, "u v w x")]


def test_lines_of_few_words(spark):
    rows = short_lines()
    want = lines_brute(rows)
    assert want[-8:] == [(100, "p q r s", 1, 0), (101, "", 1, 1), (102, "", 1, 1), (103, "Les.", 1, 0), (104, "\nOf, oner. edti", 3, 1), (105, "", 1, 1), (106, "u v w", 1, 0), (107, "u v w x", 1, 0)]
    df = spark.createDataFrame([(*r, "en", "a", len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    same(line_dedup.dedup_lines(df).select("doc_id", "text", "n_lines", "n_removed"), want)
    left = corpus_pipeline.dedup_lines(spark, df, SF)
    same(left.select("doc_id", "text"), [(d, t) for d, t, _, out in want if t or not out])


def test_op9_takes_every_line(spark, documents):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = lines_brute(texts(documents))
    assert sum(r[3] for r in want) > sum(r[3] for r in lines_brute(texts(documents), min_words=5))
    same(registry.op9_line_dedup(spark, SF), [(d, n, out, sha(t)) for d, t, n, out in want])


def test_different_texts_of_one_id_stay(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a + " more"), (5, b), (5, b + " more"), (5, b), (7, b + " other"), (7, c), (8, ""), (8, ""), (None, a)]
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    same(corpus_pipeline.near_duplicates(spark, df, SF).select("doc_id", "text"), [(3, a), (5, b), (7, c), (8, ""), (None, a)])


def test_lines_of_rows_that_share_an_id(spark):
    """Equal and different texts of one doc_id or of none: each line of a set stays once."""
    rows = [(None, "one line of words"), (None, "one line of words"), (7, "x\nq w e r t y"), (7, "z\nq w e r t y"), (8, "q w e r t y"), (8, "q w e r t y\nnew")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, doc int").repartition(3)
    got = line_dedup.dedup_lines(df).select("doc_id", "text", "n_lines", "n_removed")
    same(got, lines_brute(rows))
    assert sorted(r.n_removed for r in got.collect()) == [0, 0, 1, 1, 1, 1]


def test_fewer_words_can_be_left_alone(spark, families):
    rows, df = families
    want = lines_brute(rows, min_words=5)
    same(line_dedup.dedup_lines(df, line_dedup.LineJoin(min_words=5)).selectExpr("doc_id", "coalesce(text, '')", "n_lines", "n_removed"), want)


def test_good_documents_keep_their_columns(spark, edge):
    """Rows as they were, with columns named like results; their counts are those of ``judge``."""
    long = " ".join(f"word{i}" for i in range(80))
    extra = spark.createDataFrame([(20, long, "en", "a", 3, -5, "x"), (20, long, "en", "a", 4, -6, "y"), (None, long, None, None, None, None, None)], edge.schema)
    docs = edge.unionByName(extra).withColumn("host", edge.n_words)
    kept = quality_rules.good_documents(docs)
    assert kept.dtypes == docs.dtypes
    ids = sorted((r.doc_id or -1) for r in quality_rules.judge(docs).filter("kept").collect())
    assert sorted((r.doc_id or -1) for r in kept.collect()) == ids and ids.count(20) == 2 and ids.count(-1) == 1
    same(kept.filter("doc_id = 20").select("n_words", "kept", "host", "text"), [(-5, "x", -5, long), (-6, "y", -6, long)])


def test_bit_field_takes_a_byte_a_bit(spark):
    """Workers fill truth values; equal to counting the hashes."""
    from bidscope.llm import rarity
    keys = spark.range(0, 5000, 7).repartition(3)

    def put(total, batch):
        assert total.nbytes == len(total)
        total[batch.column(0).to_numpy() % len(total)] = True

    assert rarity.summed(keys, 1 << 18, np.bool_, put, np.logical_or).sum() == keys.count()
    field = setjoin.members(keys)
    assert len(field) == 1 << 21
    assert setjoin.may_hold(field, np.arange(0, 5000, 7)).all() and setjoin.may_hold(field, np.arange(5000)).sum() < 800


def test_lists_of_many_batches_come_together():
    """Whole lists in order of id, in few steps however small the batches are."""
    token = np.repeat(np.arange(300, dtype=np.int32), 10)
    ids = np.tile(np.arange(10)[::-1], 300)
    batches = [pa.record_batch({"token": token[i : i + 7], "cell": np.zeros(len(token[i : i + 7]), np.int32), "id": ids[i : i + 7]}) for i in range(0, len(token), 7)]
    found = list(setjoin._groups(iter(batches), ["token", "cell", "id"]))
    assert len(found) == 2 and sum(begins[-1] for _, begins in found) == 3000
    assert all((c["id"].reshape(-1, 10) == np.arange(10)).all() for c, _ in found)


def test_lines_kept_are_places(spark):
    rows = [(1, "a b c\n\nd e f g"), (2, "c b a\nnew line here"), (3, None), (4, "\n\nd e f g h")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    same(line_dedup.kept_lines(line_dedup.placed(df)), [(1, 0), (1, 2), (2, 1)])


def test_stars_are_components_at_once(spark, monkeypatch):
    """op1: links that are stars around their smallest nodes already are written once, without a round."""
    written = []
    monkeypatch.setattr(components, "materialise", lambda df, name: written.append(name) or df.localCheckpoint())
    edges = [(1, 5), (7, 1), (1, 5), (20, 21), (3, 3)]
    got = components.components(spark.createDataFrame(edges, "u long, v long"))
    same(got, [(5, 1), (7, 1), (1, 1), (21, 20), (20, 20)])
    assert written == ["links"]
    with pytest.raises(RuntimeError):
        components.components(spark.createDataFrame([(1, 2), (2, 3)], "u long, v long"), rounds=0)


def test_pairs_move_twice_to_be_compared(spark):
    """op1: four shuffles (pairs and payloads, for either end); every pair is judged on its own payloads."""
    pairs = spark.createDataFrame([(a, b) for a in range(6) for b in range(a + 1, 9)], "a long, b long").repartition(3)
    payloads = spark.createDataFrame([(i, str(i % 4)) for i in range(8)], "id long, payload string")
    got = setjoin.compare(pairs, payloads, lambda x, y: x == y, int)
    assert got._jdf.queryExecution().sparkPlan().toString().count("SortMergeJoin") == 2
    same(got, [(a, b) for a in range(6) for b in range(a + 1, 8) if a % 4 == b % 4])


def test_postings_of_a_list_travel_packed(spark):
    """op9: a posting is shuffled as five numbers and read back as it was, with either side of a cell and large numbers."""
    rows = [(-5, 3 << 15 | 7, 3, 1 << 40, 9, 2, -1, 5), (-5, 3 << 15 | 7, 7, 2, 1 << 30, (1 << 29) + 1, 6, -7), (2**31 - 1, 4 << 15 | 4, -1, 3, 1, 0, 0, 0), (1, 0, -1, 8, 10, 0, 3, 5), (1, 9, 9, 4, 2, 1, 0, 1)]
    packed = setjoin._lists(spark.createDataFrame(rows, setjoin.SIGNED), setjoin.SIGNED)
    assert packed.columns == ["list", "id", "size", "s0", "s1"]
    names = [n for n, _ in setjoin.fields(setjoin.SIGNED)]
    same(packed.mapInArrow(lambda batches: (b.select(names) for b in setjoin._unpacked(batches)), setjoin.SIGNED), rows)
