"""Relationships dealt to rounds of tasks that share no node.

Both ends are hashed to ``number`` groups, which makes a grid of cells. A round takes cells of
which no two are in one row or column, so its tasks touch different nodes and need not wait for
each other's locks; all cells are in some round. A node with very many relationships is spread
over the rounds by the other ends; within a round only one task may touch it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.functions.columns import quoted
from sluiceway.spec import Partition


def _groups(frame: DataFrame, partition: Partition) -> tuple[Column, Column]:
    """The groups of both ends; by values of one type where an end may be either node."""
    ends = [F.col(quoted(name)) for name in partition.grid]
    if partition.sameNodes and len({frame.select(end).schema[0].dataType for end in ends}) > 1:
        both = F.array(*ends)  # Spark finds the type that holds both
        ends = [both[0], both[1]]
    return tuple(F.pmod(F.xxhash64(end), F.lit(partition.number)).cast("int") for end in ends)


def grid_cell(frame: DataFrame, partition: Partition) -> tuple[Column, Column]:
    """The round and the task in it that write a row.

    With nodes of two kinds the rounds are the grid's diagonals. Where one node may be at both
    ends, the groups a and b are together in round a + b, in which each has no other partner.
    """
    one, two = _groups(frame, partition)
    number = F.lit(partition.number)
    if partition.sameNodes:
        return F.pmod(one + two, number), F.least(one, two)
    return F.pmod(two - one, number), one
