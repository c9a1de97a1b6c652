"""Connected components of an edge table by contraction to smallest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerline.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of the edges (a, b) but the roots.

    Alternates two steps until nothing moves: every node links its larger neighbours to its
    smallest one, then its smaller neighbours to it. The number of rounds grows with the
    logarithm of the longest chain. Every step is a pre-aggregated minimum and an equi-join with
    it. The minima are written first, so that both sides of the join are shuffled for it alone
    and adaptive execution can split a hub with a third of all edges over several tasks; lineage
    is cut by a reliable checkpoint each round.
    """
    links = materialise(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    )
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.where("a != b").distinct())
        # Smaller neighbours: links run from the larger node to the smaller.
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        links = materialise(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
