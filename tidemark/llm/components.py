"""Distributed connected components by contraction.

In every round each node points to its smallest neighbour (or to itself), the
links are renamed to the nodes pointed to, and loops and repeats vanish. A star
collapses in one round; every other component loses at least half of its nodes.
All steps are aggregations and joins on tables in the shared folder. The
minimum per node is taken before the shuffle, so a node with very many links
costs one row per task; a hot node in the renaming joins is split by the
adaptive skew join, because both sides are plain tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import keep


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the smallest node.

    Links may repeat, run in either direction or be loops; links with a null end
    are no links. A node that has only loops is not returned.
    """
    open_links = keep(_distinct(links.select("a", "b")), "links")
    rounds: list[DataFrame] = []
    while not open_links.isEmpty():
        both = open_links.union(open_links.select(F.col("b"), F.col("a")))
        low = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        points = keep(low.select("node", F.least("node", "low").alias("to")), "points")
        rounds.append(points)
        left = points.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        right = points.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        renamed = open_links.join(left, "a").join(right, "b")
        open_links = keep(
            _distinct(renamed.select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))), "links"
        )
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    final = rounds.pop()
    while rounds:
        # the node a round points to may have moved on in a later round
        later = final.select(F.col("node").alias("to"), F.col("to").alias("last"))
        final = keep(
            rounds.pop()
            .join(later, "to", "left")
            .select("node", F.coalesce("last", "to").alias("to")),
            "points",
        )
    return final.select("node", F.col("to").alias("component"))


def _distinct(links: DataFrame) -> DataFrame:
    ends = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ends.filter(F.col("a") < F.col("b")).distinct()
