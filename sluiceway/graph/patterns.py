"""Patterns over several relationships: what can be reached, and closed triangles.

Both work on the identities of nodes, or numbers for these, alone and look keys up at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.storage import Staged

#: Tables of pairs that a round is compared with; then they are written as one.
MOST_SEEN = 8


def reachable(edges: DataFrame, starts: DataFrame | None, hops: int | None, staged: Staged) -> DataFrame:
    """``start``, ``end`` and the least number of ``hops`` from one to the other, of one and more.

    ``edges`` has ``s`` and ``t``; ``starts``, if given, ``start``. Every round follows the edges
    of the pairs that the round before found first, so a cycle ends when nothing is new, and an
    edge is followed once for each start. A round's pairs are written before the next, which
    keeps plans short and survives lost executors. Pairs stay on the left of the join, the side
    whose hot nodes adaptive execution splits.
    """
    edges = staged.rows(edges.distinct())
    first = edges if starts is None else edges.join(starts.distinct().withColumnRenamed("start", "s"), "s", "left_semi")
    newest = staged.rows(first.select(F.col("s").alias("start"), F.col("t").alias("end"), F.lit(1).alias("hops")))
    seen, depth = [newest], 1
    while (hops is None or depth < hops) and not newest.isEmpty():
        depth += 1
        step = newest.join(edges, F.col("end") == F.col("s")).select("start", F.col("t").alias("end")).distinct()
        for known in seen:
            step = step.join(known, ["start", "end"], "left_anti")
        newest = staged.rows(step.withColumn("hops", F.lit(depth)))
        seen.append(newest)
        if len(seen) == MOST_SEEN:
            seen = [staged.rows(_together(seen))]
    return _together(seen)


def _together(rounds: list[DataFrame]) -> DataFrame:
    out = rounds[0]
    for rows in rounds[1:]:
        out = out.unionByName(rows)
    return out


def oriented(edges: DataFrame, staged: Staged) -> DataFrame:
    """Each pair of neighbours once, as ``u`` and ``v`` with ``rank`` of ``v``: from the node with fewer
    neighbours to that with more, so that of m pairs no node has over sqrt(2 m) of its own."""
    ends = F.col("s"), F.col("t")
    pairs = staged.rows(
        edges.where(ends[0] != ends[1]).select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()
    )
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    degrees = staged.rows(nodes.groupBy("node").agg(F.count("*").alias("degree")))
    for end in ("a", "b"):
        degree = degrees.select(F.col("node").alias(end), F.col("degree").alias(f"{end}_degree"))
        pairs = pairs.join(degree, end)
    low, high = F.struct("a_degree", "a"), F.struct("b_degree", "b")
    up = low < high
    return pairs.select(
        F.when(up, F.col("a")).otherwise(F.col("b")).alias("u"),
        F.when(up, F.col("b")).otherwise(F.col("a")).alias("v"),
        F.when(up, F.col("b_degree")).otherwise(F.col("a_degree")).alias("rank"),
    )


def lists(pairs: DataFrame) -> DataFrame:
    """``u`` with the other ends of its own pairs, by rank, as ``ends``: at most sqrt(2 m) of m pairs."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "v")))
    return pairs.groupBy("u").agg(F.transform(ordered, lambda x: x["v"]).alias("ends"))


def wedges(pairs: DataFrame) -> DataFrame:
    """``u`` and ``v`` of each pair with the ends of u's pairs after ``v`` as one list, ``rest``: what may close
    to triangles. A list takes the place of a row for every end, as what is shuffled grows with these."""
    listed = lists(pairs).where(F.size("ends") > 1).select("u", "ends", F.posexplode("ends").alias("n", "v"))
    left = F.size("ends") - F.col("n") - 1
    return listed.where(left > 0).select("u", "v", F.slice("ends", F.col("n") + 2, left).alias("rest"))


def triangles(edges: DataFrame, staged: Staged) -> DataFrame:
    """``u``, ``v``, ``w`` of every three nodes that are all neighbours, once, in whatever direction.

    Each pair's node ``v`` gets the list of ``u`` and keeps what is in its own. A node with very many
    neighbours has few of its own pairs, so the lists have at most m * sqrt(2 m) ends for m pairs, not
    the square of a hub.
    """
    pairs = staged.rows(oriented(edges, staged))
    own = lists(pairs).withColumnRenamed("u", "v")
    closed = wedges(pairs).join(own, "v").select("u", "v", F.array_intersect("rest", "ends").alias("common"))
    return closed.select("u", "v", F.explode("common").alias("w"))


def sorted_ends(*ends: Column) -> list[Column]:
    """The ends in their order, whatever place each was found at."""
    ordered = F.array_sort(F.array(*ends))
    return [ordered[n] for n in range(len(ends))]
