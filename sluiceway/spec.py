"""Job specifications: what to read, how to shape it, where to write it.

A specification arrives as these dataclasses, a dict, JSON text, a file or a
URL. Only this small description passes through the driver; the data never does.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any
from urllib.parse import ParseResult, urlparse
from urllib.request import urlopen

DEFAULT_JOB_NAME = "sluiceway job"


def _text(value: Any) -> str:
    """A JSON scalar as the text a Spark option expects."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


def _flag(value: Any) -> bool:
    return value.strip().lower() == "true" if isinstance(value, str) else bool(value)


def _whole(value: Any, default: int) -> int:
    return default if value is None or value == "" else int(value)


def _options(values: Any) -> dict[str, str]:
    if values is None:
        return {}
    if not isinstance(values, Mapping):
        raise ValueError(f"options must be key/value pairs, not {type(values).__name__}")
    return {
        key: _text(value)
        for key, value in values.items()
        if key != "_comment" and value is not None
    }


def _required(data: Mapping, key: str, owner: str) -> Any:
    value = data.get(key)
    if value is None or value == "":
        raise ValueError(f"{owner} needs '{key}'")
    return value


@dataclass(frozen=True)
class Column:
    """One projected column: a Spark SQL expression and an optional new name."""

    name: str
    alias: str = ""

    @classmethod
    def of(cls, value: "Column | str | Mapping") -> "Column":
        if isinstance(value, Column):
            return value
        if isinstance(value, str):
            return cls(value)
        return cls(_required(value, "name", "column"), _text(value.get("alias")))

    def __str__(self) -> str:
        return f"{self.name} AS {self.alias}" if self.alias.strip() else self.name


@dataclass(frozen=True)
class Partition:
    """Target partitioning: a count, and optionally the column to hash by.

    A key that holds far more than its fair share of the rows is spread over
    several partitions; ``keepTogether`` keeps every key in one.

    ``grid`` names the two columns with the ends of relationships, to write them
    in ``number`` rounds of which no two tasks touch one node; ``sameNodes`` says
    that one node may be at either end.
    """

    number: int = 0
    by: str = ""
    keepTogether: bool = False
    grid: Sequence[str] = ()
    sameNodes: bool = False

    def __post_init__(self) -> None:
        names = self.grid.split(",") if isinstance(self.grid, str) else self.grid or ()
        object.__setattr__(self, "grid", tuple(name.strip() for name in names if name.strip()))
        if self.grid and (len(self.grid) != 2 or self.number <= 0 or self.by.strip()):
            raise ValueError("a grid needs the two columns of both ends, a number of rounds and no 'by'")

    @classmethod
    def of(cls, value: "Partition | Mapping | None") -> "Partition":
        if isinstance(value, Partition):
            return value
        value = value or {}
        return cls(
            _whole(value.get("number"), 0),
            _text(value.get("by")),
            _flag(value.get("keepTogether", False)),
            value.get("grid") or (),
            _flag(value.get("sameNodes", False)),
        )


@dataclass(frozen=True)
class Source:
    """Where rows come from and how they are shaped. Options may hold secrets: not in repr."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    columns: Sequence[Column] = ()
    where: str = ""
    printSchema: bool = False
    limit: int = -1
    show: int = -1
    partition: Partition = Partition()

    def __post_init__(self) -> None:
        set_ = object.__setattr__
        set_(self, "options", _options(self.options))
        set_(self, "columns", tuple(Column.of(c) for c in self.columns or ()))
        set_(self, "where", _text(self.where))
        set_(self, "partition", Partition.of(self.partition))

    @classmethod
    def of(cls, value: "Source | Mapping") -> "Source":
        if isinstance(value, Source):
            return value
        return cls(
            format=_required(value, "format", "source"),
            options=value.get("options"),
            columns=value.get("columns") or (),
            where=value.get("where"),
            printSchema=_flag(value.get("printSchema", False)),
            limit=_whole(value.get("limit"), -1),
            show=_whole(value.get("show"), -1),
            partition=value.get("partition"),
        )


@dataclass(frozen=True)
class Target:
    """Where rows go. A blank mode means Spark's own default, error if it exists."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    mode: str = ""

    def __post_init__(self) -> None:
        object.__setattr__(self, "options", _options(self.options))
        object.__setattr__(self, "mode", _text(self.mode).strip())

    @classmethod
    def of(cls, value: "Target | Mapping") -> "Target":
        if isinstance(value, Target):
            return value
        return cls(
            format=_required(value, "format", "target"),
            options=value.get("options"),
            mode=value.get("mode"),
        )


@dataclass(frozen=True)
class JobConfig:
    """One job: a source, a target and the session settings it asks for.

    ``rejected``, if given, is a second target, for rows that a cast of the source's columns
    cannot take, as they came and with the ``reason``; without it such a row fails the job.
    """

    name: str = DEFAULT_JOB_NAME
    conf: Mapping[str, str] = field(default_factory=dict, repr=False)
    hadoopConfiguration: Mapping[str, str] = field(default_factory=dict, repr=False)
    source: Source = None  # type: ignore[assignment]
    target: Target = None  # type: ignore[assignment]
    master: str = ""
    rejected: Target | None = None

    def __post_init__(self) -> None:
        if self.source is None or self.target is None:
            raise ValueError("a job needs both 'source' and 'target'")
        set_ = object.__setattr__
        set_(self, "name", _text(self.name) or DEFAULT_JOB_NAME)
        set_(self, "master", _text(self.master).strip())
        set_(self, "conf", _options(self.conf))
        set_(self, "hadoopConfiguration", _options(self.hadoopConfiguration))
        set_(self, "source", Source.of(self.source))
        set_(self, "target", Target.of(self.target))
        set_(self, "rejected", Target.of(self.rejected) if self.rejected else None)

    @classmethod
    def load(cls, data: Any) -> "JobConfig":
        """One job from a JobConfig, dict, JSON text, path or URL."""
        data = _parsed(data)
        if isinstance(data, JobConfig):
            return data
        if not isinstance(data, Mapping):
            raise ValueError("expected one job object; use load_all for a list of jobs")
        return cls(
            name=data.get("name"),
            master=data.get("master"),
            conf=data.get("conf"),
            hadoopConfiguration=data.get("hadoopConfiguration"),
            source=data.get("source"),
            target=data.get("target"),
            rejected=data.get("rejected"),
        )

    @classmethod
    def load_all(cls, data: Any) -> "list[JobConfig]":
        """A sequence of jobs from a list, JSON array text, path or URL."""
        data = _parsed(data)
        if isinstance(data, (Mapping, JobConfig)) or not isinstance(data, Sequence):
            raise ValueError("expected a list of jobs")
        return [cls.load(item) for item in data]


def _parsed(data: Any) -> Any:
    """Dicts, lists and specs as they are; text, files and URLs parsed as JSON."""
    if isinstance(data, (JobConfig, Mapping, list, tuple)):
        return data
    if isinstance(data, os.PathLike):
        return json.loads(Path(data).read_text(encoding="utf-8"))
    if isinstance(data, ParseResult):
        data = data.geturl()
    if isinstance(data, str):
        if data.lstrip()[:1] in ("{", "["):
            return json.loads(data)
        if urlparse(data).scheme in ("file", "http", "https"):
            with urlopen(data) as body:
                return json.loads(body.read().decode("utf-8"))
        return json.loads(Path(data).read_text(encoding="utf-8"))
    raise ValueError(
        f"cannot read a job from {type(data).__name__}: pass a dict, JSON text, a path or a URL"
    )
