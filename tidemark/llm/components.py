"""Connected components of a graph whose nodes are integers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import staging


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _least_neighbour(edges: DataFrame, label: str) -> DataFrame:
    # written first: a hub's edges then meet it in a join whose large partitions Spark splits
    return staging.staged(edges.groupBy("a").agg(F.min("b").alias("m")), label)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the ends of `edges` (a, b); root is the smallest node of the component.

    Alternates large stars (larger neighbours move to the smallest one) and small stars
    (smaller neighbours do), each over all edges, until nothing changes; the rounds grow
    with the logarithm of the size, not with the length of the longest chain. Loops and
    repeated edges are allowed. Every round is written to the shared folder.
    """
    edges = staging.staged(edges.where("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).select("a", "b").distinct(), "edges")
    mark, turn = _mark(edges), 0
    while True:
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least_neighbour(both, f"large-star-{turn}")
        stars = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        # a node at the top of its star has no larger neighbours but keeps its own link
        edges = staging.staged(stars.where("a <> b").distinct(), f"large-edges-{turn}")
        least = _least_neighbour(edges, f"small-star-{turn}")
        moved = edges.join(least, "a")
        stars = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = staging.staged(stars.where("a <> b").distinct(), f"small-edges-{turn}")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return staging.staged(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()), "roots")
