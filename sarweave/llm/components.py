"""Connected components of links between nodes, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarweave.session import drop_materialized, materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """Of links (a, b): node and the least node that it reaches. Nodes are of any ordered type.

    Each step keeps one link per node and neighbour at most; no list of neighbours is ever held. The
    number of steps grows with the square of the logarithm of the longest path.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges = materialize(edges, "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), F.least("a", "m").alias("m"))
        large = both.join(least, both.a == least.x).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        new = materialize(small.select("e.a", "e.b").where("a != b").distinct(), "links")
        after = _state(new)
        drop_materialized(edges)
        edges = new
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
