"""Column expressions and option values used by the operators."""

from sluiceway.functions.columns import as_column, comparable, lossless_cast, quoted
from sluiceway.functions.placeholders import UnresolvedPlaceholder, resolve_options

__all__ = ["UnresolvedPlaceholder", "as_column", "comparable", "lossless_cast", "quoted", "resolve_options"]
