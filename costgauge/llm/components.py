"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costgauge.llm.rows import merged, stored


def components(links: DataFrame) -> DataFrame:
    """node and comp (the least node it is linked with) for every node of links(a, b), both long and not null."""
    found = tops(links)
    return found.unionByName(found.select(F.col("comp").alias("node"), "comp").distinct())


def tops(links: DataFrame) -> DataFrame:
    """As components(), without the least node of each component. The links are read several times.

    In each round every node takes its least neighbour, if that is less, and so the top of the chain that begins there; links
    are then between tops. A link that was taken joins nothing any more, so the only links of a later round are those of nodes
    that had several lesser neighbours. Two rounds at least halve what is left of a component. A node with very many links is
    a row on the other side of a join whose large side splits, and a minimum that combines before it is shuffled.
    """
    found = None
    while True:
        ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        chains, single = _chained(ordered)
        below = chains.select("node", "comp")
        found = below if found is None else raised(found, below)
        if single:
            return found
        rest = ordered.join(merged(chains), (F.col("a") == F.col("node")) & (F.col("b") != F.col("taken")))
        above = below.select(F.col("node").alias("_node"), F.col("comp").alias("_comp"))
        ends = rest.select(F.col("comp").alias("a"), "b").join(merged(above), F.col("b") == F.col("_node"), "left")
        links = stored(ends.select("a", F.coalesce("_comp", "b").alias("b")).where("a <> b").distinct(), "links")
        if links.isEmpty():
            return found


def raised(found: DataFrame, further: DataFrame) -> DataFrame:
    """The tops of all nodes, where `further` holds the tops of those that were tops in `found`."""
    above = further.select(F.col("node").alias("_node"), F.col("comp").alias("_comp"))
    moved = found.join(merged(above), F.col("comp") == F.col("_node"), "left")
    return moved.select("node", F.coalesce("_comp", "comp").alias("comp")).unionByName(further)


def _chained(ordered: DataFrame) -> tuple[DataFrame, bool]:
    """node, the lesser neighbour it has taken, and comp, the top of its chain, from links (a > b); whether all links were taken."""
    least = ordered.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("taken"), F.max("b").alias("_most"))
    chains = least.select("node", "taken", F.col("taken").alias("comp"), (F.col("_most") > F.col("taken")).alias("more"))
    while True:
        above = chains.select(F.col("node").alias("_node"), F.col("comp").alias("_comp"))
        # Two steps at once, so that short chains need no job more to see that they have ended.
        for _ in range(2):
            met = chains.join(merged(above), F.col("comp") == F.col("_node"), "left")
            moved = F.col("_comp").isNotNull().alias("moved")
            chains = met.select("node", "taken", F.coalesce("_comp", "comp").alias("comp"), "more", moved)
        chains = stored(chains, "tops")
        seen = chains.agg(F.max("moved").alias("moved"), F.max("more").alias("more")).first()
        if not seen.moved:
            return chains.select("node", "taken", "comp"), not seen.more
