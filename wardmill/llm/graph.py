"""Connected components of a graph that is a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.shared import stored


def connected_components(links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node``, ``component`` (smallest node that links reach) of every node of a link between two nodes.

    Each round points every node at its smallest neighbour, follows the pointers twice more, and replaces the nodes of the
    links by what they point at; links inside one node vanish. Chains shrink at least eightfold a round and stars at once,
    so a few rounds do. No neighbour list is ever collected, and a hot node is only a hot key of a plain sort-merge join,
    which adaptive execution splits. Null ends are ignored. Rounds are written to the shared folder.
    """
    links = stored(links.select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b"))
                   .where("a is not null and b is not null and a <> b").distinct(), "links")
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        points = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).select("node", F.least("node", "to").alias("to"))
        points = stored(points, "points")
        further = points.select(F.col("node").alias("to"), F.col("to").alias("next"))
        points = stored(points.join(further, "to").select("node", F.col("next").alias("to")), "points")
        rounds.append(points)
        left = points.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = points.select(F.col("node").alias("b"), F.col("to").alias("y"))
        links = stored(links.join(left, "a").join(right, "b").where("x <> y")
                       .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = rounds[0].select("node", F.col("to").alias("component"))
    for points in rounds[1:]:
        step = points.select(F.col("node").alias("component"), F.col("to").alias("next"))
        found = found.join(step, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
    return found
