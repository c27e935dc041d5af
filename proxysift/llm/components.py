"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxysift.session import durable


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root``: for each node of ``edges`` (``u, v``) the smallest node it reaches.

    Each round links the larger neighbours of a node, then the smaller ones, to the smallest
    of all (large star, small star), until nothing changes. Neighbours are reduced to their
    minimum per task before they meet, and never gathered.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            both = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        out = both.join(lowest, "u")
        if large:
            out = out.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        else:
            out = out.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
                lowest.select("u", F.col("low").alias("v"))
            )
        return out.where("u != v").distinct()

    def mark(pairs: DataFrame):
        found = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(found)

    now = durable(edges.select("u", "v").where("u != v").distinct())
    before = None
    for _ in range(rounds):
        now = durable(star(star(now, True), False))
        after = mark(now)
        if after == before or not after[0]:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root")).distinct()
