"""Connected components of a link table, as Spark joins.

Alternates two steps until nothing changes: every node points its larger
neighbours at the smallest node it sees, then every node points its smaller
neighbours at the smallest of them.  What remains is one star per component.
The per-node minima are combined before their shuffle, and they are written
before they are joined, so that both join sides are plain shuffled scans whose
skewed partitions (a node with very many links) AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.session import materialize

MAX_ROUNDS = 60  # steps grow with the logarithm of the longest path


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _minima(pairs: DataFrame, name: str) -> DataFrame:
    return materialize(pairs.groupBy("u").agg(F.min("v").alias("m")), name)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``links``
    (columns ``a``, ``b``; either order; loops and repeats allowed)."""
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    edges = materialize(edges.distinct(), "links")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
        least = _minima(both.select("u", F.least("u", "v").alias("v")), "minima")
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        large = materialize(large, "links")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = _minima(down, "minima")
        small = down.join(least, "u")
        small = (small.select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a > b")
                 .union(least.select(F.col("u"), F.col("m"))).distinct())
        edges = materialize(small, "links")
        new = _state(edges)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("the links did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
