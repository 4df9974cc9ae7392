"""Connected components of links between numbered nodes, as repeated star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.sources.scratch import write_table


def _least(edges: DataFrame, node: str, other: str) -> DataFrame:
    return edges.groupBy(node).agg(F.min(other).alias("least"))


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node it is linked to, itself included) of every linked node.

    ``links`` has the long columns a and b.  Rounds of two steps hang every node
    below smaller ones: neighbours above a node move to its smallest neighbour,
    then the remaining smaller ones do.  Rounds are logarithmic in the longest
    chain; each is stored, so a lost executor costs one step.  A node with very
    many links is summed in every task before it moves.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges = write_table(edges, "links")
    before = _state(edges)
    while True:
        # Large star: every neighbour above a node goes to the least of its neighbourhood.
        both = edges.union(edges.select("b", "a")).toDF("n", "v")
        least = _least(both, "n", "v").select(F.col("n").alias("_n"), F.least("n", "least").alias("least"))
        moved = both.filter("v > n").join(least, F.col("n") == F.col("_n")).select(F.col("v").alias("a"), F.col("least").alias("b"))
        edges = write_table(moved.filter("a > b").distinct(), "large-star")
        # Small star: a node and its smaller neighbours go to the least of them.
        least = _least(edges, "a", "b").withColumnRenamed("a", "_n")
        moved = edges.join(least, F.col("a") == F.col("_n"))
        moved = moved.select(F.explode(F.array(F.struct("a", "least"), F.struct(F.col("b").alias("a"), "least"))).alias("e"))
        moved = moved.select(F.col("e.a").alias("a"), F.col("e.least").alias("b"))
        edges = write_table(moved.filter("a > b").distinct(), "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
