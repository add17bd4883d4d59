"""Near-duplicate embeddings by a random-projection tree forest.

1. Equal vectors of one label become one point with its number of copies, so a group of
   copies of any size is one row from here on.
2. Every tree splits each label's points recursively: points are projected on a random
   direction and cut at a quantile, and points within a band around the cut go to both sides
   (spill), so that close pairs stay together. The band's width follows the projections of
   a pair at the threshold. The cut is the quantile with few points in its band, near the
   median: beside a family of near copies, not through it. A round fits ``levels``
   levels for all nodes that are still too large, each from a bounded sample of its points,
   and routes all points; the rounds grow with the logarithm of the number of points. A
   node whose points mostly fall in the band (a family of near copies) is left whole.
3. All pairs within a leaf are compared by cosine in double precision; larger leaves are
   cut into cells, each pair of which meets once. Trees are compared one after the other,
   so the disk holds one tree's vectors at a time.
4. A pair may share several leaves. Every point carries its leaves of all trees, and a pair
   counts in the smallest one that its points share, so once, and no pairs are written: a
   cell gives each point's number of links and the smallest point of its part of the cell.
5. These (point, smallest point) links are united by ``components``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import groups
from .components import components
from .scratch import discard, materialise, ship

NODE = ["tree", "part", "node"]


@dataclass(frozen=True)
class Forest:
    """threshold: cosine from which vectors are linked; leaf: points of a leaf (nodes of over three times as many
    are split, into leaves of up to twice as many);
    band: half the spill's width, in standard deviations of a threshold pair's projected distance;
    levels: of a round; sample: points a node's cuts are fitted on; cell: points of a compared block;
    balance: what a cut far from the median costs, in shares of points copied; crowded: a node is left
    whole if one side would keep this share of it."""

    threshold: float = 0.93
    trees: int = 8
    leaf: int = 256
    band: float = 0.35
    levels: int = 5
    sample: int = 4096
    cell: int = 1024
    balance: float = 0.5
    crowded: float = 0.85
    seed: int = 12

    def half_band(self, size: int) -> float:
        return self.band * math.sqrt(max(2 - 2 * self.threshold, 0.0) / size)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equally long lists of a column as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def directions(forest: Forest, tree: int, round_: int, size: int) -> np.ndarray:
    """One unit vector for each level of a round of a tree (size x levels)."""
    d = np.random.default_rng([forest.seed, tree, round_, size]).standard_normal((size, forest.levels))
    return d / np.sqrt((d * d).sum(axis=0))


def fit_cuts(projected: np.ndarray, forest: Forest, half: float, size: int) -> np.ndarray:
    """The cut of each inner node of a subtree in heap order (1 to 2^levels - 1); NaN: the node is not split.

    ``projected``: a sample of the ``size`` points of the subtree's root.
    """
    cuts = np.full(1 << forest.levels, np.nan)
    inside = {1: np.arange(len(projected))}
    shares = np.linspace(0.1, 0.9, 17)
    for node in range(1, 1 << forest.levels):
        rows = inside.pop(node, None)
        if rows is None or len(rows) < 2 or len(rows) * size <= 2 * forest.leaf * len(projected):
            continue
        p = projected[rows, node.bit_length() - 1]
        tried = np.quantile(p, shares)
        copied = (np.abs(p[:, None] - tried[None, :]) <= half).mean(axis=0)
        cut = tried[np.argmin(copied + forest.balance * np.abs(shares - 0.5))]
        low, high = rows[p < cut + half], rows[p >= cut - half]
        # mostly a family of near copies, or nothing gained
        if max(len(low), len(high)) >= forest.crowded * len(rows):
            continue
        cuts[node] = cut
        inside[2 * node], inside[2 * node + 1] = low, high
    return cuts


def route(projected: np.ndarray, cuts: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, heap node) of every leaf of its subtree a row falls in; cuts: one row of cuts for each row."""
    rows, nodes = np.arange(len(projected)), np.ones(len(projected), np.int64)
    for level in range(projected.shape[1]):
        cut = cuts[rows, np.minimum(nodes, cuts.shape[1] - 1)]
        split = (nodes >= 1 << level) & ~np.isnan(cut)
        p = projected[rows, level]
        left, right = split & (p < cut + half), split & (p >= cut - half)
        rows, nodes = np.concatenate([rows[~split], rows[left], rows[right]]), np.concatenate([nodes[~split], 2 * nodes[left], 2 * nodes[right] + 1])
    return rows, nodes


def _usable(vec: str) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def numbered(embeddings: DataFrame) -> DataFrame:
    """rid, vec_id, part (label and length; null: the vector links with nothing), vec (doubles), written."""
    rows = embeddings.select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vec"))
    part = F.when(F.col("label").isNotNull() & _usable("vec"), F.concat_ws(":", F.size("vec"), "label"))
    return materialise(rows.select("rid", "vec_id", part.alias("part"), F.when(part.isNotNull(), F.col("vec")).alias("vec")), "forest-rows")


def classes(rows: DataFrame) -> DataFrame:
    """cls (a rid of the class), part, first (its smallest vec_id), copies, k1, k2: equal vectors of one part."""
    return rows.groupBy("part", "k1", "k2").agg(F.min("rid").alias("cls"), F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))


def _split(placed: DataFrame, points: DataFrame, big: DataFrame, forest: Forest, round_: int) -> DataFrame:
    """One round: the nodes ``big`` are cut ``levels`` deep; all others stay as they are, closed."""
    # a bounded part of each node, chosen by hash: ``sample`` points are expected of any size
    share = F.pmod(F.xxhash64("cls", *NODE), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sampled = placed.join(big, NODE).filter(share < F.lit(float(forest.sample)) / F.col("size")).join(points.select("cls", "vec"), "cls")

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        tree, part, node, size = (frame[c].iloc[0] for c in (*NODE, "size"))
        vectors = unit(np.stack(frame.sort_values("cls")["vec"].to_numpy()))
        width = vectors.shape[1]
        cuts = fit_cuts(vectors @ directions(forest, int(tree), round_, width), forest, forest.half_band(width), int(size))
        return pd.DataFrame({"tree": [tree], "part": [part], "node": [node], "cuts": [cuts]})

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees, parts = batch.column("tree").to_numpy(), batch.column("part").to_numpy(zero_copy_only=False)
            widths = np.array([int(p.split(":", 1)[0]) for p in parts], np.int64)
            for tree, width in sorted(set(zip(trees.tolist(), widths.tolist()))):
                some = batch.take(pa.array(np.flatnonzero((trees == tree) & (widths == width))))
                vectors, cuts = unit(matrix(some.column("vec"))), matrix(some.column("cuts"))
                at, heap = route(vectors @ directions(forest, tree, round_, width), cuts, forest.half_band(width))
                took = some.select(["cls", "part", "tree", "node"]).take(pa.array(at))
                names = [f"{n}/{h:x}" for n, h in zip(took.column("node").to_pylist(), heap.tolist())]
                # a node whose root could not be cut is not tried again
                yield pa.RecordBatch.from_arrays(
                    [took.column("cls"), took.column("part"), took.column("tree"), pa.array(names, pa.string()), pa.array(heap > 1)],
                    ["cls", "part", "tree", "node", "open"])

    cuts = materialise(sampled.groupBy(*NODE).applyInPandas(fit, "tree int, part string, node string, cuts array<double>"), "forest-cuts")
    routed = placed.join(cuts, NODE).join(points.select("cls", "vec"), "cls").mapInArrow(down, "cls long, part string, tree int, node string, open boolean")
    stay = placed.join(big.select(*NODE), NODE, "left_anti").select("cls", "part", "tree", "node", F.lit(False).alias("open"))
    return routed.unionByName(stay)


def leaves(points: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """cls, tree, part, node: the leaves of every point (cls, part, vec) in every tree."""
    ship(points.sparkSession)
    placed = materialise(points.select("cls", "part", F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))).alias("tree")).withColumns(
        {"node": F.lit("").cast("string"), "open": F.lit(True)}), "forest-nodes")
    for round_ in range(64):
        big = materialise(placed.filter("open").groupBy(*NODE).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 3 * forest.leaf), "forest-big")
        if big.isEmpty():
            discard(big)
            break
        after = materialise(_split(placed, points, big, forest, round_), "forest-nodes")
        discard(placed, big)
        placed = after
    return placed.drop("open")


def local_roots(linked: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each row of a symmetric boolean matrix."""
    n = len(linked)
    root = np.arange(n)
    while True:
        low = np.minimum(np.where(linked, root[None, :], n).min(axis=1), root)
        low = np.minimum(low, low[low])
        if (low == root).all():
            return root
        root = low


def cell_links(ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray, shared: np.ndarray, leaf: int, rows: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(point, smallest point of its part of the cell, links that this leaf counts) of the points with a link.

    ``shared``: each point's sorted leaves, padded; ``rows``: 0 or 1, the row of cells a point
    stands for; pairs are taken within the one row, or between the two.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors, copies, shared, rows = ids[order], vectors[order], copies[order], shared[order], rows[order]
    dots = vectors @ vectors.T
    linked = dots >= forest.threshold
    for i, j in np.argwhere(np.abs(dots - forest.threshold) < 1e-12):
        linked[i, j] = linked[j, i] = float(np.dot(vectors[min(i, j)], vectors[max(i, j)])) >= forest.threshold
    if rows.any():
        linked &= rows[:, None] != rows[None, :]
    np.fill_diagonal(linked, False)
    some = np.flatnonzero(linked.any(axis=1))
    if not len(some):
        return ids[:0], ids[:0], ids[:0]
    linked, ids, copies, shared = linked[np.ix_(some, some)], ids[some], copies[some], shared[some]
    # pairs that share a smaller leaf count there: points by smaller leaves, as products of 0/1 columns
    seen, column = np.unique(shared, return_inverse=True)
    column = column.reshape(shared.shape)
    counted = linked.copy()
    for lo in range(0, int(np.searchsorted(seen, leaf)), 1024):
        hi = min(lo + 1024, int(np.searchsorted(seen, leaf)))
        point, at = np.nonzero((column >= lo) & (column < hi))
        holds = np.zeros((len(ids), hi - lo), np.float32)
        holds[point, column[point, at] - lo] = 1
        counted &= (holds @ holds.T) == 0
    links = counted @ copies
    return ids, ids[local_roots(linked)], links


def tree_links(placed: DataFrame, points: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """cls, root, links: from every leaf of one tree; points have cls, vec, copies and their leaves of all trees."""
    sizes = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > forest.cell)
    rows = F.coalesce(F.ceil(F.col("size") / forest.cell), F.lit(1)).cast("int")
    dealt = placed.join(sizes, "leaf", "left").withColumn("rows", rows).withColumn("row", F.pmod(F.xxhash64("cls"), "rows").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).withColumns({
        "low": F.least("row", "other"), "high": F.greatest("row", "other")})
    cells = dealt.select("cls", "leaf", F.concat_ws(":", "leaf", "low", "high").alias("cell"), (F.col("row") > F.col("low")).cast("int").alias("row"),
                         (F.col("low") < F.col("high")).alias("across"))
    full = cells.join(points.select("cls", "part", "vec", "copies", "leaves"), "cls")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "cell"):
            # a leaf's name is a hash: parts that share one stay apart
            parts = group.column("part").to_numpy()
            for part in dict.fromkeys(parts.tolist()):
                some = group.filter(pa.array(parts == part))
                lists = some.column("leaves").to_pylist()
                shared = np.full((len(lists), max(map(len, lists))), np.iinfo(np.int64).max)
                for k, x in enumerate(lists):
                    shared[k, :len(x)] = x
                row = some.column("row").to_numpy()
                if some.column("across")[0].as_py() and not (row.any() and (row == 0).any()):
                    continue
                found = cell_links(some.column("cls").to_numpy(), unit(matrix(some.column("vec"))), some.column("copies").to_numpy(),
                                   shared, some.column("leaf")[0].as_py(), row, forest)
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["cls", "root", "links"])

    return full.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "cls long, root long, links long")


def links(points: DataFrame, placed: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """``tree_links`` of all trees, for points (cls, part, vec, copies) in their ``leaves``."""
    named = materialise(placed.select("cls", "tree", F.xxhash64(*NODE).alias("leaf")), "forest-leaves")
    lists = named.groupBy("cls").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    full = materialise(points.join(lists, "cls"), "forest-full")
    found = None
    for tree in range(forest.trees):
        one = materialise(tree_links(named.filter(F.col("tree") == tree).drop("tree"), full, forest), "forest-links")
        found = one if found is None else found.unionByName(one)
    discard(full, named)
    return found


def near_duplicates(embeddings: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each input row.

    A vector that is null, empty, zero or holds a null or non-finite component, or has no label,
    links with nothing; so do vectors of different lengths with each other. Repeated rows are vectors
    of their own that link with each other. A null vec_id may link and counts as a link, but names no
    component: its component_id is null if no other id is reachable; kept is true where vec_id
    and component_id are the same or both null. An empty table gives an empty result. Only
    vec_id, embedding and label are read, so other columns cannot clash.
    """
    rows = numbered(embeddings)
    ship(rows.sparkSession)
    keyed = rows.filter("part IS NOT NULL").withColumns({"k1": F.xxhash64("part", "vec"), "k2": F.xxhash64(F.lit("2"), "vec", "part")})
    known = classes(keyed)
    # equal vectors are few rows of (k1, k2) but many rids: the larger side is split by AQE
    member = materialise(keyed.select("rid", "vec_id", "part", "k1", "k2").join(known, ["part", "k1", "k2"]).select("rid", "vec_id", "cls", "first", "copies"), "forest-members")
    points = materialise(rows.join(member.filter("rid = cls").select("rid", "cls", "first", "copies"), "rid").select("cls", "part", "vec", "first", "copies"), "forest-points")
    found = links(points, leaves(points, forest), forest)
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cls").alias("u"), F.col("root").alias("v"))).withColumnsRenamed({"node": "cls"})
    reach = roots.join(points.select("cls", "first"), "cls").groupBy("root").agg(F.min("first").alias("least"))
    united = roots.join(reach, "root").select("cls", "least")
    linked = counts.join(united, "cls", "left")
    out = member.join(linked, "cls", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.least(F.col("least"), F.col("first")).alias("component_id"))
    alone = rows.filter("part IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
