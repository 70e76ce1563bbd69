"""Connected components of links between keys, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.llm.text import stored

ROUNDS = 60


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``root``) for every node with a link to another; ``root`` is the smallest node reachable.

    Each round joins every node's larger neighbours to its smallest one, then its smaller ones likewise
    (large star, small star), until nothing changes; rounds grow with the logarithm of the longest path.
    Minima are pre-aggregated, and a busy node's neighbours are spread by the join's skew handling.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = stored(edges, "links")
    for _ in range(ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = stored(small.filter("u <> v").distinct(), "links")
        moved = after.exceptAll(edges).limit(1).count() + edges.exceptAll(after).limit(1).count()
        edges = after
        if not moved:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v")).distinct()
