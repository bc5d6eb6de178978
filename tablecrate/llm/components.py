"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecrate.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """`node`, `root` for every node of `links` (a, b) that is not the least of its
    component; the least one is the root of the others.

    Each round hangs every node's larger neighbours, then all its smaller ones, on its least
    neighbour, until the stars no longer change: a logarithmic number of rounds. Minima are
    aggregated before the shuffle, a node with very many links is only ever one side of a
    join, and each round is written to the shared scratch folder.
    """
    pairs = links.where(F.col("a") != F.col("b"))
    edges = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "links")
    before = _state(edges)
    while True:
        # Large star: both directions; the neighbours above a node go to its minimum.
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = (
            both.where(F.col("b") > F.col("a"))
            .join(least, F.col("a") == F.col("n"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        # Small star: a node and its smaller neighbours go to the least of them.
        large = stored(large, "large_star")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where(F.col("a") != F.col("b")).unionAll(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
        edges = stored(small.distinct(), "small_star")
        after = _state(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
