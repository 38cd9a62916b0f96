"""Connected components of a link table by alternating large-star and small-star contraction.

Every step is a grouped minimum and a join on the node, so a node with very many links is split like any skewed join
key. The links are written after each round; rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.session import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or not larger) neighbours to the least node among it and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large \
        else links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of links (u, v); the root is the least node reachable. Roots are rows too."""
    links = materialize(links.select("u", "v").where("u <> v").distinct(), "links")
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if state == before:
            break
        before = state
        links = materialize(_star(materialize(_star(links, True), "links"), False), "links")
    stars = links.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
