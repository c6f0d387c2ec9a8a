"""Property graphs kept as tables: one per set of node labels, one per kind of edge."""

from sluiceway.graph.model import InvalidKeys, NodePattern, mapping, parse_labels
from sluiceway.graph.property_graph import PropertyGraph

__all__ = ["InvalidKeys", "NodePattern", "PropertyGraph", "mapping", "parse_labels"]
