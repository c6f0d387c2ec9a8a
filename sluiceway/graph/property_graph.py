"""Writing tables as nodes and relationships, and reading them back as tables."""

from __future__ import annotations

import re
import string
import threading
from collections.abc import Iterable, Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluiceway.functions.columns import quoted
from sluiceway.graph.buckets import open_bucketed
from sluiceway.graph.catalog import Catalog
from sluiceway.graph.model import (
    LABELS,
    NODE_ID,
    REL_TYPE,
    NodePattern,
    Table,
    end_id,
    mapping,
    parse_labels,
    refuse_reserved,
)
from sluiceway.graph.patterns import reachable, sorted_ends, triangles
from sluiceway.graph.write import GraphWrite, derived_id, union
from sluiceway.storage import Staged, staging_path

# Spark's save modes, by every name it accepts.
_MODES = {
    "append": "append",
    "overwrite": "overwrite",
    "ignore": "ignore",
    "": "error",
    "default": "error",
    "error": "error",
    "errorifexists": "error",
}

# Spark ends a recursion that has given a million rows, unless this is set.
_RECURSION_LIMIT = "spark.sql.cteRecursionRowLimit"
_recursion = threading.Lock()


def _mode(mode: str) -> str:
    try:
        return _MODES[mode.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown save mode '{mode}'") from None


class PropertyGraph:
    """A graph in one shared folder. Every write adds a version; none changes files in place.

    Appending writes the batch and nothing else. Upserting reads the stored key
    columns, and rewrites a table only if the batch changes rows of it.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark = spark
        self._root = path.rstrip("/")
        self._catalog = Catalog(spark, self._root)

    # ---- writing -------------------------------------------------------

    def write_nodes(
        self,
        frame: DataFrame,
        labels: "str | Iterable[str]",
        keys: "str | Iterable[str] | Mapping[str, str]" = (),
        mode: str = "append",
        order_by: Iterable[str] = (),
        newest: bool = False,
        buckets: int = 0,
    ) -> None:
        """Each row as a node with these labels.

        ``overwrite`` is an upsert on ``keys``: nodes that have the labels and a
        key of the batch take the batch's columns, other keys become new nodes.
        Of several rows with one key the last by ``order_by`` counts, without it
        the largest row. With ``newest`` that holds across batches too: a row that
        is before the stored one by ``order_by`` changes nothing, so batches may
        arrive in any order.

        ``buckets`` keeps a new table in so many of Spark's buckets by its keys. An
        upsert then shuffles the batch alone, never the stored side, and rewrites
        the table: for batches that hit most of it anyway.
        """
        labels, mode = parse_labels(labels), _mode(mode)
        keys = _found(frame, mapping(keys))
        refuse_reserved(keys.get(name, name) for name in frame.columns)
        if not labels:
            raise ValueError("nodes need at least one label")
        if mode == "overwrite" and not keys:
            raise ValueError("overwriting nodes needs node keys")
        if newest and (mode != "overwrite" or not mapping(order_by)):
            raise ValueError("keeping the newest rows needs mode overwrite and an order")
        if buckets and mode != "overwrite":
            raise ValueError("buckets need mode overwrite, and node keys")
        with GraphWrite(self._catalog, self._root, self.open) as write:
            exists = any(table.labels == labels for table in write.tables)
            if exists and mode == "ignore":
                return
            if exists and mode == "error":
                raise ValueError(f"nodes with the labels {':'.join(labels)} exist already")
            order_by = _found(frame, mapping(order_by))
            frame = frame.select(
                *(F.col(quoted(name)).alias(keys.get(name, name)) for name in frame.columns)
            )
            write.nodes(
                frame,
                labels,
                tuple(keys.values()),
                mode == "overwrite",
                [keys.get(name, name) for name in order_by],
                newest,
                buckets,
            )
            write.publish()

    def delete_nodes(
        self,
        frame: DataFrame,
        labels: "str | Iterable[str]",
        keys: "str | Iterable[str] | Mapping[str, str]",
        detach: bool = True,
    ) -> None:
        """Remove the nodes that have all these labels and a key of ``frame``, and their relationships.

        Without ``detach`` it fails if one of them has relationships. Keys that no node
        has, and NULLs, remove nothing. Only folders with such rows are rewritten.
        """
        names = _found(frame, mapping(keys))
        if not names or not parse_labels(labels):
            raise ValueError("removing nodes needs labels and node keys")
        wanted = frame.select(*_renamed(names, ""))
        with GraphWrite(self._catalog, self._root, self.open) as write:
            if write.remove_nodes(wanted, parse_labels(labels), tuple(names.values()), detach):
                write.publish()

    def delete_relationships(
        self,
        frame: DataFrame,
        rel_type: str,
        source: NodePattern,
        target: NodePattern,
        keys: "str | Iterable[str] | Mapping[str, str]" = (),
    ) -> None:
        """Remove the relationships between the nodes that rows name, and with their values of ``keys`` if any.

        The nodes stay. Rows that name no relationship, and NULLs, remove nothing.
        """
        keys, starts, ends = (_found(frame, mapping(m)) for m in (keys, source.keys, target.keys))
        wanted = frame.select(*_renamed(starts, "source."), *_renamed(ends, "target."), *_renamed(keys, "rel."))
        patterns = (replace(source, keys=starts), replace(target, keys=ends))
        with GraphWrite(self._catalog, self._root, self.open) as write:
            if write.remove_edges(wanted, rel_type, patterns, [f"rel.{name}" for name in keys.values()]):
                write.publish()

    def clear_properties(
        self,
        frame: DataFrame,
        labels: "str | Iterable[str]",
        keys: "str | Iterable[str] | Mapping[str, str]",
        properties: "str | Iterable[str]",
    ) -> None:
        """Set properties of the nodes that have all these labels and a key of ``frame`` to NULL.

        Keys that no node has add none; a property that a node lacks is NULL already.
        """
        names, gone = _found(frame, mapping(keys)), list(mapping(properties))
        if not names or not gone or set(gone) & set(names.values()):
            raise ValueError("clearing needs node keys, and properties that are no keys")
        wanted = frame.select(*_renamed(names, ""))
        with GraphWrite(self._catalog, self._root, self.open) as write:
            if write.clear(wanted, parse_labels(labels), tuple(names.values()), gone):
                write.publish()

    def write_relationships(
        self,
        frame: DataFrame,
        rel_type: str,
        source: NodePattern,
        target: NodePattern,
        mode: str = "append",
        properties: "str | Iterable[str] | Mapping[str, str] | None" = None,
        keys: "str | Iterable[str] | Mapping[str, str]" = (),
        order_by: Iterable[str] = (),
    ) -> None:
        """Each row as a relationship between the nodes its key columns name.

        Columns that are no node key become properties, unless ``properties``
        lists which. ``overwrite`` keeps one relationship per pair of nodes and
        values of ``keys``, the properties that belong to its identity. Both
        ends and the relationships appear in one version.
        """
        mode = _mode(mode)
        keys, starts, ends = (_found(frame, mapping(m)) for m in (keys, source.keys, target.keys))
        refuse_reserved([*starts.values(), *ends.values()])
        if properties is None:
            chosen = {name: name for name in frame.columns if name not in {*starts, *ends}}
        else:
            chosen = _found(frame, mapping(properties))
        chosen = {**chosen, **keys}
        table = Table(
            rel_type=rel_type,
            source_labels=source.labels,
            source_keys=tuple(starts.values()),
            target_labels=target.labels,
            target_keys=tuple(ends.values()),
        )
        with GraphWrite(self._catalog, self._root, self.open) as write:
            exists = any(known.identity == table.identity for known in write.tables)
            if exists and mode == "ignore":
                return
            if exists and mode == "error":
                raise ValueError(f"relationships of type {rel_type} exist already")
            order = {
                name: f"__order{i}" for i, name in enumerate(_found(frame, mapping(order_by)))
            }
            named = frame.select(
                *_renamed(starts, "source."),
                *_renamed(ends, "target."),
                *_renamed(chosen, "rel."),
                *_renamed(order, ""),
            )
            identity = tuple(f"rel.{name}" for name in keys.values())
            patterns = (replace(source, keys=starts), replace(target, keys=ends))
            write.edges(named, table, patterns, identity, mode == "overwrite", list(order.values()))
            write.publish()

    def merge_pattern(
        self,
        frame: DataFrame,
        rel_type: str,
        source: NodePattern,
        target: NodePattern,
        keys: "str | Iterable[str] | Mapping[str, str]" = (),
    ) -> None:
        """Merge ``(source)-[rel_type {keys}]->(target)`` for each row.

        Nodes and relationships that exist are left alone. ``keys`` belong to the
        relationship's identity: one pair of nodes with two dates has two.
        """
        ends = (NodePattern(end.labels, end.keys, "overwrite") for end in (source, target))
        self.write_relationships(frame, rel_type, *ends, "overwrite", properties=(), keys=keys)

    # ---- reading -------------------------------------------------------

    def read_nodes(self, labels: "str | Iterable[str]") -> DataFrame:
        """Nodes that have all these labels, with their labels and properties."""
        wanted = parse_labels(labels)
        return self._nodes(self._catalog.load()[1], wanted)

    def read_edges(self, rel_type: str) -> DataFrame:
        """Relationships of a type with the keys of both ends and their properties."""
        found = self._edge_tables(self._catalog.load()[1], rel_type)
        rows = union([self.open(table) for table in found])
        return rows.drop(*map(end_id, ("source", "target"))).withColumn(REL_TYPE, F.lit(rel_type))

    def read_relationships(
        self,
        rel_type: str,
        source_labels: "str | Iterable[str]" = (),
        target_labels: "str | Iterable[str]" = (),
    ) -> DataFrame:
        """Relationships of a type joined with the nodes at both ends.

        Columns are prefixed ``source.``, ``target.`` and ``rel.``.
        """
        tables = self._catalog.load()[1]
        wanted = {"source": parse_labels(source_labels), "target": parse_labels(target_labels)}
        frames = []
        for table in self._edge_tables(tables, rel_type):
            ends = {"source": table.source_labels, "target": table.target_labels}
            nodes = {
                side: self._node_tables(tables, (*labels, *wanted[side]))
                for side, labels in ends.items()
            }
            if not all(nodes.values()):
                continue  # none of these relationships ends in such nodes
            edges = self.open(table)
            frame = edges.drop(*(c for c in edges.columns if c.startswith(("source.", "target."))))
            for side, found in nodes.items():
                rows = self._labelled(found)
                for key in table.source_keys if side == "source" else table.target_keys:
                    kind = edges.schema[f"{side}.{key}"].dataType
                    if key in rows.columns and rows.schema[key].dataType != kind:
                        rows = rows.withColumn(key, F.col(quoted(key)).try_cast(kind))
                rows = rows.select(
                    F.col(quoted(NODE_ID)).alias(end_id(side)),
                    F.col(quoted(LABELS)).alias(f"<{side}.labels>"),
                    *(
                        F.col(quoted(name)).alias(f"{side}.{name}")
                        for name in rows.columns
                        if name not in (LABELS, NODE_ID)
                    ),
                )
                # Edges stay on the left: a node with very many of them is a hot
                # key there, which adaptive execution splits.
                frame = frame.join(rows, end_id(side))
            ordered = [
                name
                for prefix in ("<source.labels", "source.", "<target.labels", "target.", "rel.")
                for name in frame.columns
                if name.startswith(prefix)
            ]
            frames.append(
                frame.select(F.lit(rel_type).alias(REL_TYPE), *(quoted(name) for name in ordered))
            )
        if not frames:
            labels = ":".join(sorted({*wanted["source"], *wanted["target"]}))
            raise ValueError(f"the graph has no nodes with the labels {labels} at the ends of {rel_type}")
        return union(frames)

    def reach(
        self, rel_type: str, starts: DataFrame | None = None, hops: int | None = None
    ) -> DataFrame:
        """What can be reached over relationships of a type: the keys of both ends and the least ``hops``.

        From every node that such a relationship leaves, or from those whose keys are in
        ``starts``, a frame with columns called as they are. ``hops`` bounds the length of
        paths; without it all that can be reached is found, cycles or not. A node is reached
        from itself if a path leads back. The result is a table that stays in the staging
        folder for as long as it is read.
        """
        found = self._edge_tables(self._catalog.load()[1], rel_type)
        edges = union([self.open(table) for table in found])
        ids = edges.select(F.col(quoted(end_id("source"))).alias("s"), F.col(quoted(end_id("target"))).alias("t"))
        left, right = (_end_keys(edges, side, name) for side, name in (("source", "start"), ("target", "end")))
        with Staged(self._spark) as staged:
            from_ids = None
            if starts is not None:
                names = [f"source.{name}" for name in starts.columns]
                from_ids = left.join(starts.toDF(*names), names, "left_semi").select("start")
            pairs = reachable(ids, from_ids, hops, staged)
            rows = pairs.join(left, "start").join(right, "end").drop("start", "end")
            return self._result(rows.select(*(quoted(n) for n in rows.columns if n != "hops"), "hops"))

    def triangles(self, rel_type: str) -> DataFrame:
        """Every three nodes that relationships of a type join with each other, in whatever direction.

        ``first``, ``second`` and ``third`` are structs of their keys, in order. Several relationships
        of a pair count as one, those of a node with itself not. Kept as the result of ``reach`` is.
        """
        found = self._edge_tables(self._catalog.load()[1], rel_type)
        edges = union([self.open(table) for table in found])
        ends = [_end_keys(edges, side, "node") for side in ("source", "target")]
        ends = [rows.toDF(*(name.split(".", 1)[-1] for name in rows.columns)) for rows in ends]
        both = union(ends)
        names = [name for name in both.columns if name != "node"]
        with Staged(self._spark) as staged:
            nodes = staged.rows(both.groupBy("node").agg(*(F.max(F.col(quoted(n))).alias(n) for n in names)))
            # half as long as identities; used if no two nodes have one
            number = F.xxhash64
            if not nodes.groupBy(number("node")).count().where("count > 1").isEmpty():
                number = F.col
            ids = edges.select(*(number(quoted(end_id(side))).alias(n) for side, n in (("source", "s"), ("target", "t"))))
            rows = triangles(ids, staged)
            for end in ("u", "v", "w"):
                keys = F.struct(*(F.col(quoted(name)) for name in names)).alias(f"{end}_keys")
                rows = rows.join(nodes.select(number("node").alias(end), keys), end)
            ordered = sorted_ends(F.col("u_keys"), F.col("v_keys"), F.col("w_keys"))
            return self._result(rows.select(*(c.alias(n) for c, n in zip(ordered, ("first", "second", "third")))))

    def _result(self, rows: DataFrame) -> DataFrame:
        """The rows as a table in the staging folder."""
        path = staging_path(self._spark)
        rows.write.parquet(path)
        return self._spark.read.schema(rows.schema).parquet(path)

    def query(self, sql: str) -> DataFrame:
        """A Spark SQL query over the graph's tables, named in braces.

        ``{Customer}`` stands for the nodes with that label, ``{HAS_ORDER}`` for
        the relationships of that type with the keys of both ends. A query may be
        recursive, by ``UNION ALL`` and with a bound on its depth: Spark keeps no
        set of what it has seen, and ``reach`` does. A recursive one may give any
        number of rows, unless the session sets a limit of its own, and its result
        is kept as that of ``reach`` is.
        """
        names = {name for _, name, _, _ in string.Formatter().parse(sql) if name}
        tables = self._catalog.load()[1]
        labels = {label for table in tables for label in table.labels}
        frames = {
            name: self._nodes(tables, (name,)) if name in labels else self.read_edges(name)
            for name in names
        }
        rows = self._spark.sql(sql, **frames)
        if not re.search(r"\bwith\s+recursive\b", sql, re.IGNORECASE) or self._spark.conf.get(_RECURSION_LIMIT, None):
            return rows
        # the limit counts when rows are made, so they are made here
        with _recursion:
            self._spark.conf.set(_RECURSION_LIMIT, "-1")
            try:
                return self._result(rows)
            finally:
                self._spark.conf.unset(_RECURSION_LIMIT)

    def _nodes(self, tables: list[Table], labels: Iterable[str]) -> DataFrame:
        found = self._node_tables(tables, labels)
        if not found:
            raise ValueError(f"the graph has no nodes with the labels {':'.join(labels)}")
        return self._labelled(found).drop(NODE_ID)

    @staticmethod
    def _node_tables(tables: list[Table], labels: Iterable[str]) -> list[Table]:
        return [table for table in tables if table.labels and set(labels) <= set(table.labels)]

    def _labelled(self, tables: list[Table]) -> DataFrame:
        return union(
            [
                self.open(table).withColumn(LABELS, F.array(*map(F.lit, table.labels)))
                for table in tables
            ]
        )

    @staticmethod
    def _edge_tables(tables: list[Table], rel_type: str) -> list[Table]:
        found = [table for table in tables if table.rel_type == rel_type]
        if not found:
            raise ValueError(f"the graph has no relationships of type {rel_type}")
        return found

    # ---- housekeeping ----------------------------------------------------

    def folders(self) -> list[str]:
        """The data folders the newest version uses."""
        return sorted(path for table in self._catalog.load()[1] for path in table.paths)

    def compact(self) -> None:
        """Join small folders, of which every append adds one, in a new version."""
        with GraphWrite(self._catalog, self._root, self.open) as write:
            before = list(write.tables)
            write.compact()
            if write.tables != before:
                write.publish()

    def clean(self, keep_versions: int = 1, older_than_hours: float = 24) -> list[str]:
        """Remove older versions and the data folders that none of the newest versions uses.

        Folders younger than ``older_than_hours`` stay: a write may be about to
        publish them, or a job still reads them. Returns what was removed.
        """
        versions = self._catalog.versions()
        kept = versions[-keep_versions:]
        used = {
            path.split("/data/")[-1].split("/")[0]
            for version in kept
            for table in self._catalog.load(version)[1]
            for path in table.paths
        }
        storage = self._catalog.storage
        for version in versions[:-keep_versions]:
            self._catalog.forget(version)
        removed = [
            folder
            for name in storage.names(f"{self._root}/data")
            if name not in used
            and storage.age_seconds(folder := f"{self._root}/data/{name}") >= 3600 * older_than_hours
        ]
        for folder in removed:
            storage.remove(folder)
        return removed

    def open(self, table: Table) -> DataFrame:
        """A stored table. Its schema is known, so no file footer is read to plan.

        Identities that relationships have not stored are made of their ends' keys where they are used.
        """
        if table.buckets:
            return open_bucketed(self._spark, table)
        rows = self._spark.read.schema(table.schema).parquet(*table.paths)
        for side, origin in table.ends.items():
            found = derived_id(origin, f"{side}.")
            if table.mixed:
                found = F.coalesce(F.col(quoted(end_id(side))), found)
            rows = rows.withColumn(end_id(side), found)
        return rows

    # ---- job options ---------------------------------------------------

    @classmethod
    def from_options(cls, spark: SparkSession, options: Mapping[str, str]) -> "PropertyGraph":
        if not options.get("path"):
            raise ValueError("the graph format needs the option 'path', a shared folder")
        return cls(spark, options["path"])

    def read_options(self, options: Mapping[str, str]) -> DataFrame:
        """What a job's source options ask for: nodes, relationships or a SQL query."""
        if options.get("query"):
            return self.query(options["query"])
        if options.get("relationship") and options.get("relationship.hops"):
            hops = options["relationship.hops"].strip().lower()
            return self.reach(options["relationship"], hops=None if hops == "all" else int(hops))
        if options.get("relationship"):
            return self.read_relationships(
                options["relationship"],
                options.get("relationship.source.labels", ""),
                options.get("relationship.target.labels", ""),
            )
        if options.get("labels"):
            return self.read_nodes(options["labels"])
        raise ValueError("reading a graph needs 'labels', 'relationship' or 'query'")

    def write_options(self, frame: DataFrame, options: Mapping[str, str], mode: str) -> None:
        """What a job's target options ask for: nodes or relationships."""
        order_by = list(mapping(options.get("order.by")))
        delete = options.get("delete", "").strip().lower()
        if delete not in ("", "true", "false", "detach"):
            raise ValueError(f"delete '{delete}': true, detach or false")
        late = options.get("order.late", "overwrite").strip().lower()
        if late not in ("overwrite", "ignore"):
            raise ValueError(f"order.late '{late}': overwrite or ignore")
        if options.get("relationship"):
            strategy = options.get("relationship.save.strategy", "keys")
            if strategy.strip().lower() != "keys":
                raise ValueError(f"relationship.save.strategy '{strategy}': only keys is known")
            source, target = (
                NodePattern(
                    options.get(f"relationship.{side}.labels", ""),
                    options.get(f"relationship.{side}.node.keys", ""),
                    options.get(f"relationship.{side}.save.mode", ""),
                )
                for side in ("source", "target")
            )
            if delete in ("true", "detach"):
                self.delete_relationships(
                    frame, options["relationship"], source, target, options.get("relationship.keys")
                )
                return
            self.write_relationships(
                frame,
                options["relationship"],
                source,
                target,
                mode,
                options.get("relationship.properties"),
                options.get("relationship.keys"),
                order_by,
            )
        elif options.get("labels") and delete in ("true", "detach"):
            self.delete_nodes(frame, options["labels"], options.get("node.keys"), delete == "detach")
        elif options.get("labels") and options.get("clear"):
            self.clear_properties(frame, options["labels"], options.get("node.keys"), options["clear"])
        elif options.get("labels"):
            buckets = int(options.get("node.buckets") or 0)
            keys = options.get("node.keys")
            self.write_nodes(frame, options["labels"], keys, mode, order_by, late == "ignore", buckets)
        elif options.get("query"):
            raise ValueError(
                "graph query text cannot be written; describe the pattern with 'labels' and "
                "'node.keys', or with 'relationship', its ends and 'relationship.keys'"
            )
        else:
            raise ValueError("writing a graph needs 'labels' or 'relationship'")


def _renamed(columns: Mapping[str, str], prefix: str) -> list[Column]:
    return [F.col(quoted(name)).alias(prefix + wanted) for name, wanted in columns.items()]


def _end_keys(edges: DataFrame, side: str, name: str) -> DataFrame:
    """The nodes at an end, once each: their identity as ``name``, and the keys that relationships have of them."""
    keys = [item for item in edges.columns if item.startswith(f"{side}.")]
    node = F.col(quoted(end_id(side))).alias(name)
    return edges.groupBy(node).agg(*(F.max(F.col(quoted(key))).alias(key) for key in keys))


def _found(frame: DataFrame, columns: Mapping[str, str]) -> dict[str, str]:
    """``columns`` as ``frame`` spells them; a name without a new one keeps that spelling."""
    spelled = {name.lower(): name for name in frame.columns}
    missing = [name for name in columns if name.lower() not in spelled]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} among {', '.join(frame.columns)}")
    actual = {name: name if name in frame.columns else spelled[name.lower()] for name in columns}
    return {
        actual[name]: wanted if wanted != name else actual[name]
        for name, wanted in columns.items()
    }
