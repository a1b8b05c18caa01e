"""Connected components over an edge table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.staging import staged


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """One row ``(node, component)`` per node of ``edges``; ``component`` is its smallest node.

    Alternates star contractions: in each round every node's larger, then every
    node's smaller neighbours are tied to the smallest neighbour. A hub's
    neighbours are reduced to one minimum before the shuffle, and the join back
    is an equi-join that Spark may split, so a hub needs no task of its own.
    Rounds grow with the logarithm of the longest path. Null ends are ignored;
    repeated and reversed edges change nothing; no edges give no rows.
    """
    now = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v").distinct())
    for _ in range(max_rounds):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = both.join(least, both.u == least.n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        tied = large.join(least, large.u == least.n)
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(tied.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = staged(small)
        # a forest of stars is reached when no node is both a root and a leaf and no leaf has two roots
        roots = after.select(F.col("v").alias("u")).distinct()
        done = after.join(roots, "u", "left_semi").isEmpty() and after.groupBy("u").count().where("count > 1").isEmpty()
        now = after
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
