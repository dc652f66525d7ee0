"""Connected components of a graph given as edges, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """`(node, root)` for every node of `edges(u, v)`; nodes of one component share the root.

    In each round every node points to the neighbour (or itself) that comes first in a new random
    order, and the edges between different targets form the next, smaller graph. Each round is
    written to the shared folder. A node of very high degree is a join key with one row on the other
    side, and its minimum is taken with partial aggregates.
    """
    edges = materialize(edges.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "edges")
    levels: list[DataFrame] = []
    while not levels or not edges.isEmpty():
        turn = len(levels)

        def ranked(name: str, turn: int = turn):
            return F.struct(F.xxhash64(F.lit(turn), F.col(name)).alias("h"), F.col(name).alias("x"))

        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = F.least(F.min(ranked("v")), F.min(ranked("u")))
        parents = both.groupBy("u").agg(first.alias("p")).select(F.col("u").alias("node"), F.col("p.x").alias("root"))
        parents = materialize(parents, "parents")
        levels.append(parents)
        of_u = parents.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        of_v = parents.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        contracted = edges.join(of_u, "u").join(of_v, "v").where(F.col("ru") != F.col("rv"))
        edges = materialize(
            contracted.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(), "edges"
        )
    found = levels.pop()
    while levels:
        upper = found.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        found = levels.pop().join(upper, F.col("root") == F.col("_n"), "left").select(
            "node", F.coalesce("_r", "root").alias("root")
        )
    return found
