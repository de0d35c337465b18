"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motolake.llm.common import materialize, release


def with_smallest(ends: DataFrame, smallest: DataFrame, links: int, hub: int) -> DataFrame:
    """ends with m, the smallest end of a. Nodes of more than hub ends are sent to all tasks instead of hashed: n links have 2 n / hub of them at most."""
    if links <= hub or 2 * links // hub > 100_000:
        # no hub, or so many links that hubs are too many to send; then the adaptive plan splits their tasks
        return ends.join(smallest.drop("n"), "a")
    hubs = smallest.filter(F.col("n") > hub).select("a", F.col("m").alias("of_hub"))
    marked = ends.join(F.broadcast(hubs), "a", "left")
    others = marked.filter("of_hub is null").drop("of_hub").join(smallest.filter(F.col("n") <= hub).drop("n"), "a")
    return others.unionByName(marked.filter("of_hub is not null").withColumnRenamed("of_hub", "m"))


def connected_components(links: DataFrame, *, hub: int = 1_000_000) -> DataFrame:
    """(node, component): for every node of links (a, b), both long and not null, the smallest node it reaches.

    Each round halves the depth of the forest at least; a node's links are only aggregated to their
    smallest end and joined with it, never gathered, so a node with many links is no task of its own.
    """
    links = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, number = None, links.count()
    while True:
        # large star: a node gives its larger neighbours its smallest neighbour
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        large = with_smallest(ends.filter("b > a"), smallest, number, hub).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        # small star: a node and its smaller neighbours get the smallest of them
        lower = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = with_smallest(large, lower, 2 * number, hub).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(lower.select("a", F.col("m").alias("b"))).distinct()
        old, links = links, materialize(small, "links")
        release(old)
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        state = (state["n"], state["h"])
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before, number = state, state[0]
