"""Connected components of links that may be far too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import settle


def _toward_least(links: DataFrame) -> DataFrame:
    """Every node with its least neighbour (or itself, if less), next to each of its neighbours."""
    least = links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return links.join(least, "a")


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node that can be reached) for every node of ``links`` (a, b: two long columns).

    Alternates large-star and small-star steps until all links point to the root. Steps are joins with a combined
    minimum; a node with very many links is a skewed join side, never a list. NULL ends are left out; no links give
    no rows. Each round is written to the shared folder.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b").distinct()
    links, state = settle(links, "links"), None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _toward_least(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.filter("a <> b").distinct()
        # in a small step every node links its smaller neighbours, and itself, to the least of them
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        links = settle(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
