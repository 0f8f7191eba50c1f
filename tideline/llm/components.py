"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import save


def connected_components(links: DataFrame, a: str = "a", b: str = "b", label: str = "links") -> DataFrame:
    """(node, component) of every node of the links; a component is named by one of its nodes.

    In each round a node points to the smallest of its neighbours and itself, and then to what that
    one points to. Links are carried over to the nodes that are pointed to; those within one node go. With
    names that are hashes the number of nodes falls geometrically. Rounds are written, nothing is
    collected but the number of links left. Neighbours of a hot node are combined before they are shuffled.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    links = save(links.distinct(), f"{label}-0")
    mapping, step = None, 0
    while not links.isEmpty():
        step += 1
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("b"))
        points = save(lowest.select(F.col("a").alias("node"), F.least("a", "b").alias("to")), f"{label}-to")
        second = points.select(F.col("node").alias("to"), F.col("to").alias("further"))
        points = save(points.join(second, "to").select("node", F.col("further").alias("to")), f"{label}-to")
        if mapping is None:
            mapping = points.select("node", F.col("to").alias("component"))
        else:
            onward = points.select(F.col("node").alias("component"), "to")
            mapping = mapping.join(onward, "component", "left")
            mapping = save(mapping.select("node", F.coalesce("to", "component").alias("component")), f"{label}-map")
        for end in ("a", "b"):
            moved = points.select(F.col("node").alias(end), F.col("to").alias("moved"))
            links = links.join(moved, end).drop(end).withColumnRenamed("moved", end)
        links = save(links.where("a <> b").distinct(), f"{label}-{step}")
    if mapping is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return mapping
