"""Connected components over a table of links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatloom.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b), the component being its smallest node.

    Contracts the graph until no link is left: each node takes the name of the neighbour, or of itself, that comes
    first in hash order; links are rewritten to the new names and links inside a name vanish. In hash order most nodes
    vanish in each round, whatever the shape, so the number of rounds grows with the logarithm of the graph. The
    names of all rounds are then followed from the first to the last.

    Minima are partial aggregates, so a node with very many links is one row per task when it is shuffled for them;
    the joins that hand on names have unique keys on one side, so a crowded key can be split. Links from a node to
    itself are ignored, repeated links count once; an empty table gives an empty table.
    """
    pairs = stage(links.select("a", "b").where("a <> b").distinct(), "links")
    renamed = []
    while not pairs.isEmpty():
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.min(F.struct(F.xxhash64("b").alias("order"), F.col("b").alias("name")))
        named = both.groupBy("a").agg(first.alias("f"))
        own = F.struct(F.xxhash64("a").alias("order"), F.col("a").alias("name"))
        named = stage(named.select(F.col("a").alias("node"), F.least(F.col("f"), own)["name"].alias("name")), "names")
        renamed.append(named)
        left = pairs.join(named.toDF("a", "left"), "a")
        moved = left.join(named.toDF("b", "right"), "b").where("left <> right")
        pairs = stage(moved.select(F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b")).distinct(), "links")
    if not renamed:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))

    def followed(so_far: DataFrame, names: DataFrame) -> DataFrame:
        then = names.toDF("name", "next")
        return so_far.join(then, "name", "left").select("node", F.coalesce("next", "name").alias("name"))

    final = reduce(followed, renamed)
    least = final.groupBy("name").agg(F.min("node").alias("component"))
    return stage(final.join(least, "name").select("node", "component"), "components")
