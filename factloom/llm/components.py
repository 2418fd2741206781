"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of undirected ``edges`` (a, b); root is the smallest node reachable.

    Each round hangs neighbours on the smallest node around (Kiveris et al.,
    2014), so the number of rounds grows with the logarithm of the longest path.
    A hub's rows are met only in joins, which Spark can split, and in minima,
    which are pre-aggregated. Nodes may be any ordered type; rows with a null
    end, and loops, are left out; repeated edges do no harm.
    """
    links = settle(edges.select("a", "b").where("a != b").distinct())
    seen = None
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.where("b < a")
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lowest.select("a", F.col("m").alias("b"))).where("a != b").distinct()
        links = settle(small)
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = links.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
