"""Keyed merge: one row per key in a batch, and a batch merged into a table.

Every join here is an equi join with the table on the left, the side whose hot
keys adaptive execution can split. Whether the batch is broadcast is left to
Spark, which knows its size: batches are read back from files.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sluiceway.functions.columns import comparable, quoted, unused


def latest_per_key(
    frame: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the last by ``order_by``, and by the largest row where that ties.

    A grouped maximum rather than a window: each task reduces a key to one row
    before the shuffle, so a key with a third of all rows costs one row per task.
    """
    others = [name for name in frame.columns if name not in keys]
    if not others:
        return frame.dropDuplicates(list(keys))
    rank = [name for name in dict.fromkeys(order_by) if name not in keys]
    ranked = rank + [name for name in others if name not in rank]
    row = F.struct(*(F.col(quoted(name)) for name in ranked))
    if len(others) == 1 and comparable(frame.schema[others[0]].dataType):
        # A plain maximum is kept in a hash table where that of rows is sorted.
        (name,) = others
        best = F.struct(F.max(F.col(quoted(name))).alias(name))
    elif all(comparable(frame.schema[name].dataType) for name in ranked):
        best = F.max(row)
    elif rank:
        best = F.max_by(row, F.struct(*(F.col(quoted(name)) for name in rank)))
    else:
        raise ValueError("rows with a map or variant column need order_by to choose among")
    chosen = unused("__row", frame.columns)
    grouped = frame.groupBy(*(F.col(quoted(name)) for name in keys)).agg(best.alias(chosen))
    return grouped.select(
        *(
            F.col(quoted(name)) if name in keys else F.col(chosen)[name].alias(name)
            for name in frame.columns
        )
    )


def matched_keys(
    table: DataFrame, batch: DataFrame, keys: Sequence[str], unique: bool = False
) -> DataFrame:
    """The keys of ``batch`` that ``table`` holds, once each. Reads key columns only.

    Keys that may repeat in the table are reduced after the join, which leaves
    few of them and needs no shuffle of the table where the batch is small.
    """
    names = [quoted(name) for name in keys]
    found = table.select(*names).join(batch.select(*names), list(keys), "left_semi")
    return found if unique else found.distinct()


def unmatched_rows(batch: DataFrame, matched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``batch`` whose key is not among ``matched``, which is no larger."""
    return batch.join(matched, list(keys), "left_anti")


def merge_rows(
    table: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """``table`` with the columns of ``batch`` set on each row whose key it holds.

    ``batch`` has one row per key. A matched row takes every column the batch
    has, NULLs too, and keeps the others; columns new to the table are added.
    With ``order``, columns of the batch, it does so only if the stored row is
    not later by these, nor the larger where they tie.
    """
    if all(name in keys for name in batch.columns):
        return table
    return merged_columns(table, batch, keys, order, "left")


def merged_columns(
    table: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str], how: str
) -> DataFrame:
    """The columns of ``merge_rows`` over a ``left`` join, or a ``full`` one that adds the batch's other rows."""
    new = [name for name in batch.columns if name not in keys]
    taken = [*table.columns, *batch.columns]
    row = unused("__new", taken)
    names = [unused(f"__key{i}", taken) for i in range(len(keys))]
    mark = unused("__old", taken)
    incoming = batch.select(
        *(F.col(quoted(key)).alias(name) for key, name in zip(keys, names)),
        F.struct(*(F.col(quoted(name)) for name in new)).alias(row),
    )
    same = reduce(
        lambda left, right: left & right,
        (F.col(quoted(key)) == F.col(name) for key, name in zip(keys, names)),
    )

    wins = F.col(row).isNotNull()
    if ranked := [name for name in order if name in table.columns and name in new]:
        rest = [
            name for name in new
            if name in table.columns and name not in ranked and comparable(batch.schema[name].dataType)
        ]
        stored = F.struct(*(F.col(quoted(name)) for name in ranked + rest))
        given = F.struct(*(F.col(row)[name] for name in ranked + rest))
        wins &= F.col(mark).isNull() | (given >= stored)

    def merged(name: str):
        old = F.col(quoted(name)) if name in table.columns else F.lit(None)
        if name in keys and how == "full":
            return F.coalesce(old, F.col(names[list(keys).index(name)])).alias(name)
        if name not in new:
            return old
        return F.when(wins, F.col(row)[name]).otherwise(old).alias(name)

    every = table.columns + [name for name in new if name not in table.columns]
    joined = table.withColumn(mark, F.lit(True)).join(incoming, same, how)
    return joined.select(*(merged(name) for name in every))
