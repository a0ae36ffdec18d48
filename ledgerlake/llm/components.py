"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregations and two joins on the edge list. A node with very many neighbours is
pre-aggregated map-side. The aggregate is landed before it is joined back to the edges: then the join
reads two plain shuffles, and the adaptive skew join can split the node's rows. No component is ever
gathered in one task or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import landed


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a long, b long) -> (node, root): the smallest node reachable from each node that
    has an edge. Self-loops, repeated and reversed edges are allowed; nodes whose component is a
    single node do not appear. An empty edge list gives an empty result."""
    e = landed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _digest(e)
    if before[0] == 0:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(max_rounds):
        both = e.union(e.select("b", "a"))
        least = landed(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = landed(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        smallest = landed(large.groupBy("a").agg(F.min("b").alias("m")))
        small = (
            large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(smallest).distinct()
        )
        e = landed(small)
        after = _digest(e)
        if after == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
