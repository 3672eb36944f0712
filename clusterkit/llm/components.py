"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterkit.llm.common import drop_written, written


def _state(pairs: DataFrame) -> tuple:
    # Wrapping sums of hashes: the same set of pairs gives the same state.
    h = F.xxhash64("a", "b")
    return tuple(pairs.agg(F.count("*"), F.sum(h.cast("decimal(38,0)"))).first())


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """Columns node, root from edges u, v (long): the smallest node of each node's component.

    Nodes without an edge to another are left out; loops and repeated edges do no harm. Large-star
    and small-star rounds: every node's larger neighbours, then its smaller ones, are tied to the
    smallest node around it. Rounds grow with the logarithm of the longest path. Each round is
    written to the shared folder, so a lost executor repeats one round at most. A node's
    neighbours are met by joins whose hot keys Spark can split, never as a list.
    """
    pairs = edges.filter("u <> v").select(
        F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct()
    pairs = written(pairs, "components")
    state = _state(pairs)
    for _ in range(most_rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "components")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before = pairs
        pairs = written(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "components")
        drop_written(before, large)
        now = _state(pairs)
        if now == state:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = now
    raise RuntimeError("components did not settle")
