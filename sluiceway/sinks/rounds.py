"""Writing relationships in rounds of tasks that share no node."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from sluiceway.functions.columns import quoted, unused
from sluiceway.operators.grid import grid_cell
from sluiceway.sinks.write import check_target, write
from sluiceway.sources.presets import preset, presets, resolve_format
from sluiceway.spec import Partition, Target
from sluiceway.storage import Staged, Storage


def _later_mode(target: Target) -> str:
    """The mode of all rounds but the first."""
    format, _ = resolve_format(target.format, target.options)
    if any(preset(name).upserts for name in presets() if preset(name).format == format):
        return target.mode
    return "append"


def write_rounds(frame: DataFrame, target: Target, partition: Partition, strict: bool = False) -> None:
    """Save ``frame`` in ``partition.number`` rounds, one after another, by its grid's two columns.

    The rows are staged by round first, so the source is read once; each round reads its own and
    deals them to its tasks. The first round writes in the target's mode, the others append, or
    upsert where the target does. A failure leaves the rounds that were written before it.
    """
    if target.mode.strip().lower() == "ignore":
        raise ValueError("rounds cannot be written with mode 'ignore': the first would hide the others")
    check_target(frame, target, strict)
    spark, number = frame.sparkSession, partition.number
    turn = unused("round", frame.columns)
    lane = unused("lane", [*frame.columns, turn])
    at, task = grid_cell(frame, partition)
    dealt = frame.withColumns({turn: at, lane: task})
    with Staged(spark) as staged:
        path = staged.path()
        dealt.hint("rebalance", F.col(quoted(turn))).write.partitionBy(turn).parquet(path)
        there = set(Storage(spark, path).names(path))
        stored = dealt.drop(turn).schema
        mode = target.mode
        for n in range(number):
            if f"{turn}={n}" not in there:
                continue
            rows = spark.read.schema(stored).parquet(f"{path}/{turn}={n}")
            rows = rows.repartitionById(number, F.col(quoted(lane))).drop(lane)
            write(rows, replace(target, mode=mode), strict)
            mode = _later_mode(target)
        if mode == target.mode and not any(name.startswith(f"{turn}=") for name in there):
            write(frame.where(F.lit(False)), target, strict)
