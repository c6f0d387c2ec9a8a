"""Writing to any Spark data source or to a graph."""

from sluiceway.sinks.write import SelfOverwrite, write

__all__ = ["SelfOverwrite", "write"]
