"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b`` (long): the smallest node it can reach.

    Each round hangs all larger neighbours of a node on its smallest one, then all smaller ones. Links only ever move
    towards the smallest node, and the number of rounds grows with the logarithm of the longest path. A node's
    neighbours are never gathered: rounds are minimum aggregates and joins, whose hot keys adaptive execution splits.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state, mark = None, None
    while True:
        links = materialize(links, "links")
        new = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == mark:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state, mark = links, new
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        links = (
            small.select("u", F.col("m").alias("v"))
            .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct()
        )
