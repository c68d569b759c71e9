"""Connected components of very large link sets, by alternating large and small stars.

Every round is two aggregates with partial sums and two joins that stand hot nodes; its result is
written to the shared folder, so nothing is collected and no lineage grows. The number of rounds
grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.shared import attach
from tidewatch.sources import Copies


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour of a node to the smallest node among it and its neighbours.

    ``links`` (node, other) holds each link in both directions; the large star moves the greater
    neighbours, the small star the smaller ones and the node itself.
    """
    if not large:
        links = links.filter("other < node")
    centres = links.groupBy("node").agg(
        F.least(F.min("other"), F.col("node")).alias("least"), F.count("*").alias("degree")
    )
    total = links.count()
    seen = attach(links, centres, "node", "degree", total)
    if large:
        moved = seen.filter("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))
    else:
        moved = seen.select(F.col("other").alias("node"), F.col("least").alias("other")).unionByName(
            centres.select("node", F.col("least").alias("other"))
        )
    moved = moved.filter("node <> other")
    return moved if large else moved.distinct()


def both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has one link, and what it leads to has none."""
    ends = links.selectExpr("node as id", "1 as leaving", "0 as arriving").unionByName(
        links.selectExpr("other as id", "0 as leaving", "1 as arriving")
    )
    sums = ends.groupBy("id").agg(F.sum("leaving").alias("out"), F.max("arriving").alias("reached"))
    return sums.filter("out > 1 or (out = 1 and reached = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node but the smallest of its component: that smallest node.

    ``links`` has two long columns, node and other; loops and repeats do no harm. Only the last
    round's copy stays in the shared folder.
    """
    spark = links.sparkSession
    held = Copies(spark)
    links = held(links.filter("node <> other").distinct())
    while not links.isEmpty():
        after = Copies(spark)
        with Copies(spark) as keep:
            links = after(_star(both_ways(keep(_star(both_ways(links), True))), False))
        held.remove()
        held = after
        if _are_stars(links):
            break
    return links.select("node", F.col("other").alias("root"))
