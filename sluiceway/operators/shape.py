"""The steps between a source and a target, in their fixed order.

Filter, projection, schema print, limit, preview, repartition. The filter comes
first, so it sees columns the projection leaves out and never sees an alias;
both reach the scan through Catalyst.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame

from sluiceway.functions.columns import as_column
from sluiceway.operators.counts import Counts
from sluiceway.operators.repartition import repartition_rows
from sluiceway.spec import Column, Source


def filter_rows(frame: DataFrame, where: str) -> DataFrame:
    """Rows for which the SQL condition holds; all rows if it is blank."""
    return frame.where(where) if where.strip() else frame


def project(frame: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """The listed columns and expressions; all columns if none is listed."""
    return frame.select(*(as_column(c) for c in columns)) if columns else frame


def shape(scan: DataFrame, source: Source, counts: Counts | None = None) -> DataFrame:
    """``scan`` with every step its specification asks for; all lazy but the preview.

    ``counts`` watches the rows that are read and kept; the preview does without.

    The limit is Spark's own whatever its size: each task stops at so many rows,
    and any so many of theirs are kept. It is meant for trial runs; a large share
    of a table is better chosen by a filter.
    """
    if source.show > 0 and counts is not None:
        frame = project(filter_rows(scan, source.where), source.columns)
        (frame.limit(source.limit) if source.limit > 0 else frame).show(source.show)
        source = replace(source, show=-1)
    watch = counts.watch if counts is not None else lambda frame, _: frame
    kept = watch(filter_rows(watch(scan, "read"), source.where), "kept")
    return finish(project(kept, source.columns), source)


def finish(frame: DataFrame, source: Source) -> DataFrame:
    """The steps that follow the projection."""
    if source.printSchema:
        frame.printSchema()
    if source.limit > 0:
        frame = frame.limit(source.limit)
    if source.show > 0:
        frame.show(source.show)
    return repartition_rows(frame, source.partition)
