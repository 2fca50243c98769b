"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is joins and aggregates over the links; nothing is gathered on the driver but a count
and a checksum for each round. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component): each node that has a link to another one, and the least node it reaches.

    Links are undirected; null ends and links of a node to itself are left out.
    """
    at = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "links",
    )
    before = None
    for _ in range(most_rounds):
        now = tuple(at.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first())
        if now == before or not now[0]:
            return at.select(F.col("u").alias("node"), F.col("v").alias("component")).union(at.select("v", "v").distinct())
        before = now
        both = at.union(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        at = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
