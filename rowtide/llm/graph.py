"""Connected components of links that Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.frames import drop, kept


def _pairs(low, high) -> DataFrame:
    return F.least(low, high).alias("low"), F.greatest(low, high).alias("high")


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """``id`` and ``component``, the least id that it is linked with over any number of links.

    ``links`` has columns ``low`` and ``high`` of one type that can be ordered. Rounds of two steps
    (each node's greater neighbours are linked to its least neighbour, then its lesser ones) keep
    the components and flatten them to stars; the number of rounds grows with the logarithm of the
    longest path. Each round is a table in the shared folder. Nodes without a link are left out.
    Returns the path of the last table too; delete it when the result is no longer read.
    """
    start = links.select(*_pairs("low", "high")).filter("low < high").distinct()
    pairs, path = kept(start, "links")
    while True:
        # Step one: to the least neighbour of the lesser end, where that is lesser still.
        down = pairs.groupBy(F.col("high").alias("low")).agg(F.min("low").alias("least"))
        lesser, side = kept(down.join(pairs.select("low").distinct(), "low", "left_semi"), "lesser")
        chained = not lesser.isEmpty()
        if chained:
            raised = pairs.join(lesser, "low", "left").select(F.coalesce("least", "low").alias("low"), "high").distinct()
        else:
            raised = pairs
        # Step two: the lesser neighbours of a node are linked to the least of them.
        least = raised.groupBy("high").agg(F.min("low").alias("least"), F.count("*").alias("n"))
        joined = raised.join(least.filter("n > 1"), "high")
        among = joined.filter("low > least").select(F.col("least").alias("low"), F.col("low").alias("high"))
        stars = least.select(F.col("least").alias("low"), "high").union(among).distinct()
        if not chained and least.filter("n > 1").isEmpty():
            drop(links, side)
            break
        pairs, after = kept(stars, "links")
        drop(links, path, side)
        path = after
    centre = pairs.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct()
    return pairs.select(F.col("high").alias("id"), F.col("low").alias("component")).union(centre), path
