"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialise


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the smallest node it can reach.

    Alternating large-star and small-star steps: every node links its larger (then
    its smaller) neighbours to the smallest one it sees, until components are stars around
    their smallest nodes: no node with a smaller neighbour has a second one. The
    rounds grow with the logarithm of a component's size. Neighbours are summarised
    by a minimum, so a hub's neighbours are never gathered in one row, and each round
    is a written table.
    """
    both = lambda e: e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    links = materialise(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for left in range(rounds, -1, -1):
        around = both(links)
        if not around.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("m")).filter("n > 1 and m < u").count():
            break
        if not left:
            raise RuntimeError("components did not converge")
        low = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.filter("v < u")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        links = materialise(small.filter("u <> v").distinct(), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
