"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import written


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Tie the neighbours of each node to its least neighbour.

    ``large``: the greater neighbours only; else the node itself and its smaller ones.
    """
    near = _both(links) if large else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    if large:
        tied = near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        tied = near.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        tied = tied.union(least.select("a", F.col("m").alias("b")))
    return tied.filter("a <> b").distinct()


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every linked node; ``component`` is the least node it reaches.

    ``links`` has numeric columns ``a`` and ``b``; loops and repeats do no harm, rows with
    a null end link nothing.  Each round is a written table, so a lost executor costs one
    round; a node with many links sends one least value per task before the shuffle.
    Nodes without links do not appear.
    """
    edges = links.select(F.col("a"), F.col("b")).filter("a is not null and b is not null and a <> b")
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    for _ in range(rounds):
        edges = written(_star(_star(edges, True), False), "links")
        print_of = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(print_of) == seen:
            break
        seen = tuple(print_of)
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
