"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.common import discard, stored

MOST_ROUNDS = 60


def _settled(edges: DataFrame) -> bool:
    """Whether every node that has a smaller neighbour has just one, which has none itself."""
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("smaller"), F.lit(0).alias("larger")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("smaller"), F.lit(1).alias("larger")),
    )
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("smaller").alias("smaller"), F.sum("larger").alias("larger"))
    return nodes.filter("smaller > 1 or smaller > 0 and larger > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of an edge and the smallest node it is connected to.

    ``edges`` has columns a and b of type bigint; direction, repeats and loops do not matter, and
    edges with a null are ignored. Alternating large-star and small-star steps turn each component
    into a star around its smallest node in a logarithmic number of rounds. A step gathers only the
    minimum of a node's neighbours, which combines before the shuffle, and joins it back; Spark
    splits the join where a node has very many edges. Each round is stored, and the one before removed.
    """
    current = stored(
        edges.filter("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    for _ in range(MOST_ROUNDS):
        if _settled(current):
            break
        both = current.union(current.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = stored(
            both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")),
            "edges",
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        discard(current)
        current = stored(
            large.join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .filter("a != b")
            .distinct(),
            "edges",
        )
        discard(large)
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
