"""Connected components of a graph given by its edges, in Spark rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.scratch import stored


def _signature(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of the edges ``a``, ``b``.

    Large-star and small-star rounds: neighbours move to the smallest node known until nothing changes,
    after about log n rounds. A round is partial minima and joins that Spark can split, so a node with very
    many edges is no single task's work. Each round is stored.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    edges = stored(edges, "edges")
    before = _signature(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b")
        # Every edge now points from a smaller ``a`` to a larger ``b``.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        moved = small.filter("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        edges = stored(moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct(), "edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select("a").distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        roots.select(F.col("a").alias("node"), F.col("a").alias("component"))
    )
