"""Repartitioning, round robin or by the hash of one column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sluiceway.spec import Partition


def repartition_rows(frame: DataFrame, partition: Partition) -> DataFrame:
    """``frame`` in ``partition.number`` partitions; unchanged if that is not positive.

    By a column, rows are dealt over so many partitions by the column's hash, and
    adaptive execution then splits partitions over its advisory size, as a hot
    key makes them, and joins small ones. With ``keepTogether`` the number is
    exact and every key stays in one partition, whatever its size. A grid's rows
    are dealt when they are written, round by round.
    """
    number, by = partition.number, partition.by.strip()
    if number <= 0 or partition.grid:
        return frame
    if not by:
        return frame.repartition(number)
    if partition.keepTogether:
        return frame.repartition(number, F.col(by))
    return frame.hint("rebalance", number, F.col(by))
