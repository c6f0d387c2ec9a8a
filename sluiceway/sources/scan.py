"""Opening any source as a DataFrame."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from sluiceway.functions.placeholders import resolve_options
from sluiceway.sources.presets import GRAPH_FORMAT, preset, presets, resolve_format
from sluiceway.spec import Source

log = logging.getLogger(__name__)
T = TypeVar("T")

class MissingConnector(RuntimeError):
    """The format's connector is not on the class path."""


def with_connector(format: str, action: Callable[[], T]) -> T:
    """Run ``action``; if Spark cannot find the format, say which packages give it."""
    try:
        return action()
    except (AnalysisException, Py4JJavaError) as error:
        absent = ("DATA_SOURCE_NOT_FOUND", "Failed to find data source")
        if not any(mark in str(error) for mark in absent):
            raise
        packages = [
            package
            for name in presets()
            if preset(name).format == format
            for package in preset(name).packages
        ]
        hint = f"; add {', '.join(packages)}" if packages else ""
        raise MissingConnector(f"no connector for format '{format}'{hint}") from error


def jdbc_options(options: Mapping[str, str]) -> dict[str, str]:
    """JDBC options that read in parallel where the user named a partition column.

    Spark takes ``partitionColumn`` with a table only, so a query becomes a
    derived table. Without a partition column the whole read is one task.
    """
    names = {name.lower(): name for name in options}
    if "partitioncolumn" not in names:
        log.warning(
            "JDBC read without partitionColumn, lowerBound, upperBound and numPartitions: "
            "one task will read every row"
        )
        return dict(options)
    if "query" not in names:
        return dict(options)
    kept = {name: value for name, value in options.items() if name != names["query"]}
    return {**kept, "dbtable": f"({options[names['query']]}) source_query"}


def scan(spark: SparkSession, source: Source, strict: bool = False) -> DataFrame:
    """The source as it is."""
    format, options = resolve_format(source.format, resolve_options(source.options, strict))
    if format == GRAPH_FORMAT:
        from sluiceway.graph import PropertyGraph

        return PropertyGraph.from_options(spark, options).read_options(options)
    if format == "jdbc":
        options = jdbc_options(options)
    return with_connector(format, lambda: spark.read.format(format).options(**options).load())
