"""Writing a DataFrame to a target."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

from sluiceway.functions.placeholders import resolve_options
from sluiceway.sources.presets import GRAPH_FORMAT, resolve_format
from sluiceway.sources.scan import with_connector
from sluiceway.spec import Target
from sluiceway.storage import qualified

# Table formats that keep the old files until the new ones are there.
VERSIONED_FORMATS = frozenset({"delta", "iceberg", "hudi"})


class SelfOverwrite(ValueError):
    """The target would delete files the job still has to read."""


def _items(sequence) -> Iterator:
    return (sequence.apply(i) for i in range(sequence.size()))


def input_roots(frame: DataFrame) -> list[str]:
    """The folders and files that the plan names, those of its subqueries too.

    They are as many as the job's sources name, however many files lie below.
    An RDD that was read from files outside of Spark's sources cannot be told.
    """
    plan = frame._jdf.queryExecution().analyzed()
    roots: list[str] = []
    for part in (plan, *_items(plan.subqueriesAll())):
        for leaf in _items(part.collectLeaves()):
            kind = leaf.getClass().getSimpleName()
            files = None
            if kind == "LogicalRelation":
                relation = leaf.relation()
                if relation.getClass().getSimpleName() == "HadoopFsRelation":
                    files = relation.location()
            elif kind == "DataSourceV2Relation" and "datasources.v2" in leaf.table().getClass().getName():
                table = leaf.table()
                files = table.fileIndex() if hasattr(table, "fileIndex") else None
            elif kind == "LogicalRDD":
                lineage = leaf.rdd().toDebugString()
                if any(name in lineage for name in ("HadoopRDD", "FileScanRDD", "BinaryFileRDD")):
                    raise SelfOverwrite(
                        "the rows come from an RDD over files, and it cannot be told whether the "
                        "target holds these; write to another place"
                    )
            if files is not None:
                roots += [item.toString() for item in _items(files.rootPaths())]
    return roots


def _holds(folder: str, path: str) -> bool:
    """Whether ``path`` is ``folder`` or lies within it; so also if only the hosts are unknown."""
    one, two = urlsplit(folder), urlsplit(path)
    if one.netloc and two.netloc and one.netloc != two.netloc:
        return False
    outer, inner = one.path.rstrip("/"), two.path.rstrip("/")
    return inner == outer or inner.startswith(outer + "/")


def refuse_self_overwrite(spark: SparkSession, folder: str, reads: Iterable[str]) -> None:
    target = qualified(spark, folder)
    for path in reads:
        source = qualified(spark, path)
        if _holds(target, source) or _holds(source, target):
            raise SelfOverwrite(f"overwriting {folder} would delete the job's own input {path}")


def check_target(frame: DataFrame, target: Target, strict: bool = False) -> None:
    """Fail if overwriting the target would delete what the frame reads."""
    format, options = resolve_format(target.format, resolve_options(target.options, strict))
    folders = [value for name, value in options.items() if name.lower() == "path"]
    replaced = format != GRAPH_FORMAT and format not in VERSIONED_FORMATS
    if target.mode.strip().lower() == "overwrite" and folders and replaced:
        roots = input_roots(frame)
        for folder in folders:
            refuse_self_overwrite(frame.sparkSession, folder, roots)


def write(frame: DataFrame, target: Target, strict: bool = False) -> None:
    """Save ``frame`` as the target says; a blank mode is Spark's default.

    Overwriting a place that holds the frame's own input, or lies in it, is refused.
    """
    format, options = resolve_format(target.format, resolve_options(target.options, strict))
    if format == GRAPH_FORMAT:
        from sluiceway.graph import PropertyGraph

        graph = PropertyGraph.from_options(frame.sparkSession, options)
        graph.write_options(frame, options, target.mode)
        return
    check_target(frame, target, strict)
    writer = frame.write.format(format).options(**options)
    if target.mode:
        writer = writer.mode(target.mode)
    with_connector(format, writer.save)
