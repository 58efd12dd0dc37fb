"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.sources.workspace import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component: its smallest node.

    Each round hangs larger neighbours on the smallest one (large star) and then
    smaller ones on it too (small star), until every node hangs on its root.  Rounds
    grow with the logarithm of the longest path, and each one is written down, so the
    lineage stays short.  Neighbour lists are never gathered: both steps are a
    minimum by node, combined before the shuffle, and a join, which Spark splits
    where one node has very many edges.
    """
    now = staged(
        edges.filter("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct()
    )
    seen = None
    while True:
        mark = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        both = now.union(now.select("v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("low"))
        large = (
            both.join(lowest, "u")
            .filter("v > u")
            .selectExpr("v AS u", "least(u, low) AS v")
            .distinct()
        )
        smallest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(smallest, "u").filter("v <> low").selectExpr("v AS u", "low AS v")
        now = staged(small.union(smallest.selectExpr("u", "low AS v")).distinct())
    return now.selectExpr("u AS node", "v AS component").union(
        now.selectExpr("v AS node", "v AS component").distinct()
    )
