"""Connected components of a graph given as links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourly_star.llm.common import Scratch

MAX_ROUNDS = 100


def connected_components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link; links are (a, b), root is the least node.

    Large-star links every greater neighbour to the least one, small-star every
    smaller neighbour; both only need the least neighbour of a node, which is
    aggregated map-side and written before it is joined: in a stage of its own
    adaptive execution may split the join when one node has very many links. A
    round is a written table; only its row count and a checksum come to the
    driver.
    """
    edges = scratch.keep(links.where("a <> b")
                         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .distinct())
    seen = _mark(edges)
    first = scratch.tables
    for _ in range(MAX_ROUNDS):
        if seen[0] == 0:
            break
        large = scratch.keep(_large_star(scratch, edges))
        edges = scratch.keep(_small_star(scratch, large))
        mark = _mark(edges)
        scratch.drop(*range(scratch.tables - 3, scratch.tables))
        if scratch.tables - 4 > first:
            scratch.drop(scratch.tables - 4)
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b")).distinct()


def _large_star(scratch: Scratch, edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = scratch.keep(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).withColumn(
        "m", F.least("u", "m")))
    return (both.where("b > a").join(least, F.col("a") == F.col("u"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(scratch: Scratch, edges: DataFrame) -> DataFrame:
    least = scratch.keep(edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")))
    joined = edges.join(least, F.col("a") == F.col("u"))
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("u", "m")).where("a <> b").distinct())


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return (row[0], row[1])
