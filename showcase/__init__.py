"""Every operator as a query over the whole test tables, with SQL to compare by."""

from showcase import expressions, files, graphs, moved, patterns, rows  # noqa: F401  (they register)
from showcase.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
