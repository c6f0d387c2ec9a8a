"""Row operators: filter, projection, limit, preview, repartitioning, keyed merge."""

from sluiceway.operators.merge import latest_per_key, matched_keys, merge_rows, unmatched_rows
from sluiceway.operators.repartition import repartition_rows
from sluiceway.operators.shape import filter_rows, project, shape

__all__ = [
    "filter_rows",
    "latest_per_key",
    "matched_keys",
    "merge_rows",
    "project",
    "repartition_rows",
    "shape",
    "unmatched_rows",
]
