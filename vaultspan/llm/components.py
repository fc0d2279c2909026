"""Connected components of a graph of links, by large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each step
is a minimum over each node's links, which are shuffled once for it; no task holds a component
and nothing is gathered on the driver but two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultspan.llm.scratch import Scratch


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest of its neighbourhood."""
    least = F.least("u", F.min("v").over(Window.partitionBy("u")))
    return (
        _both_ways(links)
        .withColumn("least", least)
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = F.min("v").over(Window.partitionBy("u"))
    return (
        down.withColumn("least", least)
        .select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
        .where("u <> v")
        .distinct()
    )


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable from every node that has a link.

    ``links`` has long columns ``u`` and ``v``. Self-links are ignored, repeated
    links and both directions are allowed; nodes without links do not appear.
    """
    current = scratch.store(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        stepped = scratch.store(_small_star(_large_star(current)), "links")
        row = stepped.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40)).alias("h")).first()
        scratch.drop(current)
        current = stepped
        if (row["n"], row["h"]) == before:
            break
        before = (row["n"], row["h"])
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
