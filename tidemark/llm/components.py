"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node joins its larger neighbours to its smallest neighbour, itself included."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node joins its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _print(edges: DataFrame) -> tuple:
    """The number of edges and a sum over their hashes: equal for equal sets."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root: for every node of an edge the smallest node that it reaches.

    ``edges`` has the columns u and v, of one orderable type; loops are left out. Each round is
    one large-star and one small-star, written to a table, until the edges no longer change:
    then every node is joined to its root. A node's smallest neighbour is a partial aggregate
    and the joins back are inner, so that a node with very many neighbours is split.
    """
    now = stage(edges.where("u <> v").select("u", "v").distinct(), "edges")
    seen = _print(now)
    while seen[0]:
        now = stage(_small_star(_large_star(now).distinct()).distinct(), "edges")
        before, seen = seen, _print(now)
        if seen == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
