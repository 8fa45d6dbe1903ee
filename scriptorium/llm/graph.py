"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    A round replaces neighbours by the smallest of them, first those above a
    node and then those below, until every node hangs on its root; the number of
    rounds grows with the logarithm of the longest path. Minima are taken by
    aggregation with partial sums and joined back, so that a node with many
    neighbours is never gathered. Each round is written to the shared folder.
    """
    pairs = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    print_of = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    seen = print_of(pairs)
    while seen[0]:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        pairs = materialise(small.where("a <> b").distinct(), "edges")
        if (now := print_of(pairs)) == seen:
            break
        seen = now
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
