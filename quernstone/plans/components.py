"""Connected components of an edge table by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.plans.scratch import stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a and b); a component is its smallest node.

    Each round sends neighbours to the smallest node known nearby, which roughly squares the distance a
    label travels, so the number of rounds follows the logarithm of a component's diameter. Rounds are
    written to the shared folder, never kept in an executor. Self-loops and null ends are ignored.

    A node with very many neighbours is a hot key of the joins; they are sort-merge joins, whose skewed
    partitions adaptive execution splits, and never gather a node's neighbours in one row.
    """
    edge = F.struct(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stored(edges.filter("a <> b").select(edge.alias("e")).select("e.u", "e.v").distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.u", "e.v").filter("u <> v").distinct(), "edges")
        row = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select("v", "v").toDF("node", "component").distinct())
