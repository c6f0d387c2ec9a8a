"""What a graph is made of, and the text forms job options use for it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql.types import StructType

# Columns every read adds; node and relationship properties keep their own names.
LABELS = "<labels>"
REL_TYPE = "<rel.type>"
# What every stored node has, and no read shows.
NODE_ID = "<id>"


def end_id(side: str) -> str:
    """The column of stored relationships with the identity of the node at an end."""
    return f"<{side}.id>"


def refuse_reserved(names: Iterable[str]) -> None:
    """Fail if a property is called as the columns that every node or read has."""
    clash = sorted({name for name in names if name.lower() in (NODE_ID, LABELS)})
    if clash:
        raise ValueError(f"{', '.join(clash)} cannot be the name of a property or key: rename it")


class InvalidKeys(ValueError):
    """A batch holds NULL keys, or keys that the graph's key type cannot hold."""


def parse_labels(labels: "str | Iterable[str]") -> tuple[str, ...]:
    """Labels as a sorted set, from ``":Person:Customer"`` or a list of names."""
    parts = labels.split(":") if isinstance(labels, str) else labels
    return tuple(sorted({part.strip() for part in parts if part.strip()}))


def mapping(columns: "str | Iterable[str] | Mapping[str, str] | None") -> dict[str, str]:
    """Column to property, from ``"o_custkey:id,o_name"``, a list of names or a dict."""
    if isinstance(columns, Mapping):
        return dict(columns)
    items = columns.split(",") if isinstance(columns, str) else list(columns or ())
    pairs = (item.strip().partition(":") for item in items if item.strip())
    return {column.strip(): (renamed or column).strip() for column, _, renamed in pairs}


@dataclass(frozen=True)
class NodePattern:
    """One end of a relationship: its labels, its key columns and what to do with nodes.

    ``mode``: ``match`` uses only nodes that exist, ``append`` adds one per key,
    ``overwrite`` adds those that are missing.
    """

    labels: tuple[str, ...]
    keys: Mapping[str, str]
    mode: str = "match"

    def __post_init__(self) -> None:
        object.__setattr__(self, "labels", parse_labels(self.labels))
        object.__setattr__(self, "keys", mapping(self.keys))
        object.__setattr__(self, "mode", self.mode.strip().lower() or "match")
        if not self.labels or not self.keys:
            raise ValueError("each end of a relationship needs labels and node keys")
        if self.mode not in ("match", "append", "overwrite"):
            raise ValueError(f"unknown node save mode '{self.mode}'")


@dataclass(frozen=True)
class Table:
    """One stored table: the Parquet folders that make up its current state.

    ``unique`` are columns of which no two rows share all values, if any are known.
    ``buckets``, if any, is the number of Spark's buckets by these that its one folder has.
    ``derived``, if any, is what the identities of all its nodes follow from: a value of the
    table's own and the names of their keys. ``source_derived`` and ``target_derived`` are what
    a relationship's ends follow from so in rows that have no identities stored; if ``mixed``,
    there may be rows that have.
    """

    labels: tuple[str, ...] = ()
    rel_type: str = ""
    source_labels: tuple[str, ...] = ()
    source_keys: tuple[str, ...] = ()
    target_labels: tuple[str, ...] = ()
    target_keys: tuple[str, ...] = ()
    schema: StructType = field(default_factory=StructType)
    paths: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    buckets: int = 0
    derived: tuple[str, ...] = ()
    source_derived: tuple[str, ...] = ()
    target_derived: tuple[str, ...] = ()
    mixed: bool = False

    @property
    def ends(self) -> dict[str, tuple[str, ...]]:
        """The sides whose nodes' identities follow from their keys, at least in some rows, and from what."""
        found = {"source": self.source_derived, "target": self.target_derived}
        return {side: origin for side, origin in found.items() if origin}

    @property
    def left_out(self) -> dict[str, tuple[str, ...]]:
        """The sides whose identities no row has stored, and what all of them follow from."""
        return {} if self.mixed else self.ends

    @property
    def identity(self) -> tuple:
        return (
            self.labels,
            self.rel_type,
            self.source_labels,
            self.source_keys,
            self.target_labels,
            self.target_keys,
        )

    def has(self, columns: Iterable[str]) -> bool:
        return set(columns) <= set(self.schema.names)

    def with_ends(self, ends: Mapping[str, tuple[str, ...]], mixed: bool = False) -> "Table":
        source, target = (ends.get(side, ()) for side in ("source", "target"))
        return replace(self, source_derived=source, target_derived=target, mixed=mixed)

    def with_data(
        self, schema: StructType, paths: Iterable[str], unique: Iterable[str]
    ) -> "Table":
        return replace(self, schema=schema, paths=tuple(paths), unique=tuple(sorted(unique)), buckets=0)

    @classmethod
    def from_dict(cls, values: Mapping) -> "Table":
        plain = {
            name: tuple(value) if isinstance(value, list) else value
            for name, value in values.items()
        }
        return cls(**{**plain, "schema": StructType.fromJson(values["schema"])})

    def to_dict(self) -> dict:
        return {**vars(self), "schema": self.schema.jsonValue()}
