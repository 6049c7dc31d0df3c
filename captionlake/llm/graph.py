"""Connected components of an edge table by alternating stars, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captionlake.llm.common import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(low, "u").where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(low, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node with an edge but the roots themselves.

    ``edges`` has columns ``u`` and ``v`` that can be compared, not null; loops and repeated edges are
    ignored. An empty table gives an empty result. A hub's edges meet its minimum in a join that
    adaptive execution may split, and minima are combined before the shuffle.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star-edges")
    mark = None
    while True:
        then = now
        now = materialize(_small_star(_large_star(then)), "star-round")
        discard(then)
        # equal counts and equal checksums of two rounds: every node points at its root
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if seen == mark or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen
