"""Connected components by stars, entirely in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airledger.llm.tables import freed_shuffles
from airledger.session import Staging
from airledger.sources.files import delete_path


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is its least node."""
    found = stars(edges)
    return found.union(found.select("component", "component").distinct())


def stars(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)`` but the least of its component.

    Each round links the neighbours of a node to their least one, first the larger ones, then
    the smaller ones, until every edge joins a node to the least of its component. Rounds grow
    with the logarithm of the longest chain. Minima are aggregated before they are shuffled,
    and joins may split a hub, so a node with a third of all edges is no bottleneck. Edges of
    earlier rounds are deleted.
    """
    spark = edges.sparkSession
    area = Staging(spark, "edges")

    def put(df: DataFrame, name: str) -> DataFrame:
        with freed_shuffles(spark):
            return area.put(df, name)

    number = 0
    now = put(_ordered(edges).distinct(), "0")
    while not _are_stars(now):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select("b", F.least("a", "m").alias("m"))
        # No more rows than edges, so equal ones may stay until the next step.
        large = put(_ordered(large.toDF("a", "b")), f"{number}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))
        small = large.join(least, "a").select(F.inline(ends).alias("a", "b"))
        after = put(_ordered(small).distinct(), f"{number + 1}")
        for done in (f"{number}", f"{number}-large"):
            delete_path(spark, f"{area.root}/{done}")
        now, number = after, number + 1
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )


def _are_stars(edges: DataFrame) -> bool:
    """Is every node of ``edges``, larger end first, either linked once downwards or only upwards?"""
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")),
    )
    tally = (
        edges.select(F.inline(ends))
        .groupBy("node")
        .agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    )
    with freed_shuffles(edges.sparkSession):
        return tally.where("down + up > 1").isEmpty()
