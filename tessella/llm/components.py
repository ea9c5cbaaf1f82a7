"""Connected components by alternating large and small stars on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node that has a link; ``root`` is its component's smallest node.

    ``edges``: two integer columns, in any orientation; null ends, loops and repeats are ignored.
    Each round replaces links by links to the smallest neighbour, so their number never exceeds
    the input's, and a component ends as a star about its smallest node. Only a count and a
    checksum of each round come to the driver. Raises RuntimeError if ``max_rounds`` do not suffice.
    """
    links = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).filter("u <> v").distinct()
    links = materialize(links, "links")
    seen = None
    for _ in range(max_rounds):
        links = materialize(_small_star(materialize(_large_star(links), "larger")), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = tuple(now)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written here and below, so that the join deals both sides anew and Spark can split the links of a hub.
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = materialize(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
