"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import Staged, part_count

#: Links that a partition holds, about.
PART_LINKS = 200_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``a`` and ``component``, the smallest node reachable, for every node of links (``a``, ``b``).

    The large-star step ties every larger neighbour of a node to the smallest of its neighbourhood,
    the small-star step the smaller ones and itself. Only minima are grouped, reduced before the
    shuffle, so no neighbourhood is gathered; each step is written to the shared folder. Links with
    a null end or both ends the same are left out; no links give no rows.
    """
    edges = Staged(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .distinct(),
        "links",
    )
    before = _state(edges.read())
    while before[0]:
        # few links in few partitions, which then need no shuffle
        parts = part_count(links.sparkSession, 2 * before[0], PART_LINKS)
        one = edges.read()
        both = one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(parts)
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        )
        grown = Staged(large, "large-star")
        big = grown.read().coalesce(parts)  # every edge points from the larger end to the smaller
        lows = big.groupBy("a").agg(F.min("b").alias("least"))
        small = big.join(lows, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        after_edges = Staged(small.where("a <> b").distinct(), "small-star")
        edges.discard()
        grown.discard()
        edges, last = after_edges, before
        before = _state(edges.read())
        if before == last:
            break
    found = edges.read()
    return found.select("a", F.col("b").alias("component")).unionByName(
        found.select(F.col("b").alias("a"), F.col("b").alias("component")).distinct()
    )
