"""Connected components of a graph given by its edges, by joins and grouping only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.staging import settled


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component``: the smallest node reachable, for each node that has an edge.

    ``edges``: columns ``a, b`` of one orderable type, in any direction, repeats and loops allowed.
    Rounds of large-star (each node sends its larger neighbours to its smallest one) and small-star
    (smaller neighbours likewise) end when every node hangs on its smallest one; their number
    grows with the logarithm of the longest path. A node with very many neighbours is one key
    of a grouped minimum, which is taken map side first, and of a join that AQE can split. Every round is a table
    in the shared folder, so a lost executor repeats one round only.
    """
    now = settled(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        nxt = settled(small.where("u <> v").distinct(), name)
        # Equal edge sets: as all edges are distinct, equal counts and nothing new.
        if nxt.count() == now.count() and nxt.join(now, ["u", "v"], "left_anti").isEmpty():
            break
        now = nxt
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
