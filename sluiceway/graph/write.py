"""How one write changes a graph's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, NumericType, StructType

from sluiceway.functions.columns import lossless_cast, quoted, unused
from sluiceway.graph.buckets import upserted, write_bucketed
from sluiceway.graph.catalog import Catalog
from sluiceway.graph.model import NODE_ID, InvalidKeys, NodePattern, Table, end_id
from sluiceway.operators.merge import (
    latest_per_key,
    matched_keys,
    merge_rows,
    merged_columns,
    unmatched_rows,
)

# The folder of a stored row, in its file's path.
_FOLDER = r"/data/([0-9a-f]{32}(?:/bucket_*=\d+)?)/[^/]*$"

# Types of keys from which identities follow: those that have one text for each value.
_PLAIN = {"tinyint", "smallint", "int", "bigint", "string", "date"}


def union(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows; a column missing somewhere is NULL there, one of mixed types is text."""
    kinds: dict[str, list[DataType]] = {}
    for item in (item for frame in frames for item in frame.schema):
        kinds.setdefault(item.name, []).append(item.dataType)
    mixed = {
        name: F.col(quoted(name)).cast("string")
        for name, found in kinds.items()
        if len({kind.simpleString() for kind in found}) > 1
        and not all(isinstance(kind, NumericType) for kind in found)
    }
    if mixed:
        frames = [
            frame.withColumns({name: mixed[name] for name in frame.columns if name in mixed})
            for frame in frames
        ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def widened(old: StructType, new: StructType) -> StructType:
    """``old`` with the columns only ``new`` has; a column may not change its type."""
    known = {item.name.lower(): item for item in old}
    fields = list(old)
    for item in new:
        before = known.get(item.name.lower())
        if before is None:
            fields.append(item)
        elif before.name != item.name:
            raise ValueError(f"column '{item.name}' is stored as '{before.name}'")
        elif before.dataType.simpleString() != item.dataType.simpleString():
            raise ValueError(
                f"column '{item.name}' is stored as {before.dataType.simpleString()}, "
                f"not {item.dataType.simpleString()}: cast it"
            )
    return StructType(fields)


def new_id() -> Column:
    """An identity of its own for every row that is written."""
    return F.unhex(F.replace(F.expr("uuid()"), F.lit("-"), F.lit("")))


@dataclass(frozen=True)
class Batch:
    """Rows written to folders of their own, and read back from there.

    ``ends``: the sides of relationships whose identities are not written, as they follow from
    keys, and from what.
    """

    frame: DataFrame
    schema: StructType
    paths: tuple[str, ...]
    ends: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


class GraphWrite:
    """One write: the tables as they will be, made known in one step at the end.

    Batches are written before they are used, so a source is read once, however
    many tables its rows end up in, and Spark knows a batch's size when it joins.
    Every node has an identity, and relationships name both ends by these.

    Use it in a ``with`` block: at its end the folders are removed that no table
    of a published version has.
    """

    # A table's rows are kept in folders of about this size, by the hash of
    # their keys, so that a change rewrites only the folders it hits.
    folder_bytes = 1 << 30

    def __init__(self, catalog: Catalog, root: str, read: Callable[[Table], DataFrame]) -> None:
        self._catalog, self._root, self._read = catalog, root, read
        self._version, self.tables = catalog.load()
        self._written: list[str] = []
        self._published = False

    def __enter__(self) -> "GraphWrite":
        return self

    def __exit__(self, *_) -> None:
        used = {path for table in self.tables for path in table.paths} if self._published else ()
        for folder in self._written:
            if not any(path == folder or path.startswith(f"{folder}/") for path in used):
                self._catalog.storage.remove(folder)

    def publish(self) -> None:
        self._catalog.publish(self._version + 1, self.tables)
        self._published = True

    # ---- nodes and relationships ---------------------------------------

    def nodes(
        self,
        frame: DataFrame,
        labels: tuple[str, ...],
        keys: Sequence[str],
        upsert: bool,
        order_by: Sequence[str] = (),
        newest: bool = False,
        buckets: int = 0,
    ) -> None:
        """Add nodes, or upsert them on ``keys``; if ``newest``, not over rows that are later by the order."""
        known = self._node_tables(labels, keys)
        own = Table(labels=labels, unique=tuple(sorted(keys)), buckets=buckets)
        stored = known[0] if len(known) == 1 and known[0].labels == labels else None
        if buckets and known and (stored is None or not stored.buckets or stored.unique != own.unique):
            raise ValueError("nodes with these labels are stored without buckets by these keys")
        own = stored if stored is not None and stored.buckets and stored.unique == own.unique else own
        typed = self._typed(frame, keys, _key_types(known, keys))
        rows = self._reduced(typed, keys, upsert, order_by)
        batch = self._write(rows.withColumn(NODE_ID, new_id()))
        self._check(batch, keys, typed)
        order = list(order_by) if newest else []
        if upsert and own.buckets:
            self._merge_buckets(own, batch, order)
        else:
            self._merge(Table(labels=labels), batch, keys, upsert, known, order)

    def edges(
        self,
        frame: DataFrame,
        table: Table,
        ends: tuple[NodePattern, NodePattern],
        identity: Sequence[str],
        upsert: bool,
        order_by: Sequence[str],
    ) -> None:
        """Add relationships, or upsert them, and first the nodes they need.

        ``frame`` has the keys as ``source.*`` and ``target.*``, properties as
        ``rel.*``. A row whose node to match does not exist writes nothing.
        """
        known = [item for item in self.tables if item.rel_type == table.rel_type]
        sides = dict(zip(("source", "target"), ends))
        keys = {side: [f"{side}.{name}" for name in end.keys.values()] for side, end in sides.items()}
        types = _key_types([item for item in known if item.has(identity)], identity)
        for side, end in sides.items():
            names = list(end.keys.values())
            found = _key_types(self._node_tables(end.labels, names), names)
            types |= {f"{side}.{name}": kind for name, kind in found.items()}
        every = [*keys["source"], *keys["target"], *identity]
        typed = self._typed(frame, every, types)
        derived = self._derived_ends(typed, sides)
        # the columns of the order only say which row counts
        rows = self._reduced(typed, every, upsert, order_by).drop(*order_by)
        names = rows.columns
        for side, origin in derived.items():
            rows = rows.withColumn(end_id(side), derived_id(origin, f"{side}."))
        # a table's rows without identities have ends that follow from one thing
        other = self._current(table).ends
        ends_out = {side: origin for side, origin in derived.items() if other.get(side, origin) == origin}
        batch = self._write(rows, (), 0, ends_out)
        self._check(batch, every, typed)

        rows = batch.frame
        for side, end in sides.items():
            if end.mode == "match":
                rows = self._with_ids(rows, side, end)
        for side, end in sides.items():
            if end.mode == "append":
                rows = rows.withColumn(end_id(side), _key_id(keys[side]))
        self._add_ends(rows, sides, derived)
        pair = [end_id("source"), end_id("target"), *identity]
        if len(derived) == 2:
            self._merge(table, batch, pair, upsert, known)
            return
        for side, end in sides.items():
            if end.mode == "overwrite" and side not in derived:
                rows = self._with_ids(rows, side, end)
        rows = rows.select(*map(quoted, names), *(quoted(end_id(side)) for side in sides))
        new = Batch(rows, rows.schema, (), ends_out)
        if upsert and known and set(names) > set(every):
            # properties change stored relationships, which takes the batch twice
            new = self._write(rows, (), 0, ends_out)
        self._merge(table, new, pair, upsert, known)

    # ---- steps -----------------------------------------------------------

    def _node_tables(self, labels: Iterable[str], keys: Iterable[str]) -> list[Table]:
        """Tables whose nodes have all the labels, and maybe more, and the keys."""
        return [
            table
            for table in self.tables
            if table.labels and set(labels) <= set(table.labels) and table.has(keys)
        ]

    def _with_ids(self, rows: DataFrame, side: str, end: NodePattern) -> DataFrame:
        """The rows with each node at ``side`` that has their keys; none if there is no such node."""
        names = list(end.keys.values())
        nodes = [
            self._read(table).select(
                *(F.col(quoted(name)).alias(f"{side}.{name}") for name in names),
                F.col(quoted(NODE_ID)).alias(end_id(side)),
            )
            for table in self._node_tables(end.labels, names)
        ]
        if not nodes:
            return rows.where(F.lit(False)).withColumn(end_id(side), F.lit(None).cast("binary"))
        # Relationships stay on the left: a node with very many of them is a hot
        # key there, which adaptive execution splits.
        return rows.join(union(nodes), [f"{side}.{name}" for name in names])

    def _origin(self, end: NodePattern) -> tuple[str, ...]:
        """What the identities of all stored nodes that an end may mean follow from; empty if from nothing."""
        found = self._node_tables(end.labels, end.keys.values())
        if len(found) == 1 and found[0].derived[1:] == tuple(sorted(end.keys.values())):
            return found[0].derived
        return ()

    def _derived_ends(self, rows: DataFrame, sides: dict[str, NodePattern]) -> dict[str, tuple[str, ...]]:
        """The ends whose nodes' identities follow from their keys, so that no join has to find them, and from what.

        Nodes that a write adds are given such identities where no other node can be meant by
        the same end: the other end's nodes are others, or named in the same way.
        """
        out: dict[str, tuple[str, ...]] = {}
        for side, other in (("source", "target"), ("target", "source")):
            end, two = sides[side], sides[other]
            names = sorted(end.keys.values())
            same = (end.labels, names, end.mode) == (two.labels, sorted(two.keys.values()), two.mode)
            within = set(end.labels) <= set(two.labels) or set(two.labels) <= set(end.labels)
            kinds = [rows.schema[f"{side}.{name}"].dataType.simpleString() for name in names]
            if same and kinds != [rows.schema[f"{other}.{name}"].dataType.simpleString() for name in names]:
                continue
            if end.mode != "overwrite" or not set(kinds) <= _PLAIN or (two.mode != "match" and within and not same):
                continue
            found = self._node_tables(end.labels, names)
            if not found:
                there = any(table.labels == end.labels for table in self.tables)
                origin = () if there else (uuid.uuid4().hex, *names)
                out[side] = out[other] if same and other in out else origin
            elif found[0].labels == end.labels:
                out[side] = self._origin(end)
        return {side: origin for side, origin in out.items() if origin}

    def _add_ends(
        self, rows: DataFrame, sides: dict[str, NodePattern], derived: dict[str, tuple[str, ...]]
    ) -> None:
        """The nodes that relationships need, those of both ends in one write where that can be."""
        new = {side: end for side, end in sides.items() if end.mode != "match"}
        frames = {side: self._new_nodes(rows, side, end, derived.get(side, ())) for side, end in new.items()}
        if len(new) == 2 and _apart(new["source"], new["target"], frames):
            self._put_nodes(new, frames, derived)
            return
        for side, end in new.items():
            # the second end may find the nodes of the first
            frame = self._new_nodes(rows, side, end, derived.get(side, ()))
            self._put_nodes({side: end}, {side: frame}, derived)

    def _new_nodes(self, rows: DataFrame, side: str, end: NodePattern, origin: tuple[str, ...]) -> DataFrame:
        """Nodes for the keys at ``side``; unless they are appended, those that do not exist."""
        names = list(end.keys.values())
        own = [F.col(quoted(f"{side}.{name}")).alias(name) for name in names]
        if end.mode == "append":
            return rows.select(*own, F.col(quoted(end_id(side))).alias(NODE_ID)).distinct()
        nodes = rows.select(*own).distinct()
        for table in self._node_tables(end.labels, names):
            stored = self._read(table).select(*map(quoted, names))
            unique = set(table.unique) == set(names)
            nodes = nodes.join(stored if unique else stored.distinct(), names, "left_anti")
        return nodes.withColumn(NODE_ID, derived_id(origin) if origin else new_id())

    def _put_nodes(
        self, sides: dict[str, NodePattern], frames: dict[str, DataFrame], derived: dict[str, tuple[str, ...]]
    ) -> None:
        if not frames:
            return
        for side, batch in self._write_sides(frames).items():
            end = sides[side]
            names = list(end.keys.values())
            if batch.frame.isEmpty():
                if self._node_tables(end.labels, names):
                    continue
                batch = self._write(batch.frame)  # the labels are known from now on
            self._add(Table(labels=end.labels), batch, names if end.mode == "overwrite" else (), derived.get(side, ()))

    @staticmethod
    def _typed(frame: DataFrame, keys: Sequence[str], types: dict[str, DataType]) -> DataFrame:
        """The rows with their keys in the stored type; NULL where that cannot hold them."""
        values: dict[str, Column] = {}
        for key in keys:
            value, current = F.col(quoted(key)), frame.schema[key].dataType
            wanted = types.get(key, current)
            if wanted.simpleString() != current.simpleString():
                cast, changed = lossless_cast(value, current, wanted)
                value = F.when(~changed, cast)
            values[key] = value.alias(key)
        return frame.select(*(values.get(name, quoted(name)) for name in frame.columns))

    @staticmethod
    def _reduced(
        typed: DataFrame, keys: Sequence[str], unique: bool, order_by: Sequence[str]
    ) -> DataFrame:
        """One row per key if ``unique``."""
        return latest_per_key(typed, keys, order_by) if unique else typed

    @staticmethod
    def _check(batch: Batch, keys: Sequence[str], typed: DataFrame) -> None:
        """No key may be NULL, as one that the stored type cannot hold is by now.

        The statistics in the files answer this without reading them.
        """
        if not keys:
            return
        missing = reduce(lambda a, b: a | b, (F.col(quoted(key)).isNull() for key in keys))
        if not batch.frame.where(missing).isEmpty():
            raise InvalidKeys(
                f"{typed.where(missing).count()} rows have a key among {', '.join(keys)} "
                "that is NULL or does not fit the stored type"
            )

    def _merge(
        self,
        table: Table,
        batch: Batch,
        keys: Sequence[str],
        upsert: bool,
        known: Sequence[Table],
        order: Sequence[str] = (),
        add: bool = True,
    ) -> None:
        """Upsert: set the batch's columns on the rows of ``known`` that have its keys.
        Rows that are left, or all rows, are added to ``table`` if ``add``."""
        stored = [item for item in known if upsert and item.has(keys)]
        end_columns = ("source.", "target.") if table.rel_type else ()
        columns = {
            name
            for name in batch.schema.names
            if name not in keys and name != NODE_ID and not name.startswith(end_columns)
        }
        left, rows = batch.frame, None
        for item in stored:
            unique = set(item.unique) == set(keys)
            old = self._read(item)
            large = unique and self._large(batch, item)
            by = _by_keys(keys, _alike(item, batch))
            if not columns:
                found = old.select(*map(quoted, by)) if large else matched_keys(old, batch.frame, by, unique)
                left = unmatched_rows(left, found, by)
                continue
            alone = add and len(stored) == 1 and item.identity == table.identity and not item.buckets
            if large and alone and _meet(old, batch.frame, by):
                self._merge_whole(item, batch, by, columns, order)
                return
            name = unused("__folder", by)
            folder = F.regexp_extract(F.col("_metadata.file_path"), _FOLDER, 1)
            place = old.select(*map(quoted, by), folder.alias(name))
            wanted = batch.frame.select(*map(quoted, by))
            hit_rows = place.join(wanted, by, "left_semi")
            hits = self._write(hit_rows if unique else hit_rows.distinct()).frame
            # As many as the table has folders, whatever the number of rows.
            folders = {row[0] for row in hits.select(name).distinct().collect()}
            if not folders:
                continue
            found = hits.drop(name) if unique else hits.drop(name).distinct()
            hit = [path for path in item.paths if path.split("/data/")[-1] in folders]
            kept = [path for path in item.paths if path not in hit]
            schema = widened(item.schema, StructType([f for f in batch.schema if f.name in columns]))
            changes = batch.frame.select(*map(quoted, by), *map(quoted, sorted(columns)))
            merged = merge_rows(self._read(item.with_data(item.schema, hit, ())), changes, by, order)
            size = sum(self._catalog.storage.size(path) for path in hit)
            new = self._write(merged, by, size, item.left_out)
            still = () if columns & set(item.unique) else item.unique
            origin = () if columns & set(item.derived[1:]) else item.derived
            self._put(replace(item.with_data(schema, [*kept, *new.paths], still), derived=origin))
            rows = batch.frame.count() if rows is None else rows
            if left is not None:
                left = None if found.count() == rows else unmatched_rows(left, found, by)
        if left is None or not add:
            return
        split = upsert and (known or not table.rel_type) and self._size(batch) > self.folder_bytes
        if left is not batch.frame or not batch.paths or split:
            batch = self._write(left, _by_keys(keys, batch.ends) if upsert else (), self._size(batch), batch.ends)
            if known and batch.frame.isEmpty():
                return
        self._add(table, batch, keys if upsert else ())

    def _large(self, batch: Batch, item: Table) -> bool:
        """Whether a batch likely hits all folders of a table, so that finding out which takes more than it saves."""
        size = sum(self._catalog.storage.size(path) for path in item.paths)
        return bool(batch.paths) and self._size(batch) * (40 if len(item.paths) == 1 else 2) >= size

    def _merge_whole(
        self, item: Table, batch: Batch, keys: Sequence[str], columns: set[str], order: Sequence[str]
    ) -> None:
        """Upsert into all of a table by one join. Other columns than ``columns`` are the batch's in new rows only."""
        schema = widened(item.schema, batch.schema)
        ends = _alike(item, batch)
        made = {end_id(side): derived_id(origin, f"{side}.") for side, origin in ends.items()}
        names = [name for name in batch.schema.names if name not in made]
        others = [name for name in names if name not in keys and name not in columns]
        renamed = {name: unused(f"__given{n}", schema.names) for n, name in enumerate(others)}
        given = batch.frame.select(*(F.col(quoted(n)).alias(renamed.get(n, n)) for n in names))
        merged = merged_columns(self._read(item).drop(*made), given, keys, order, "full")
        rows = merged.select(
            *(
                made[n].alias(n) if n in made
                else F.coalesce(F.col(quoted(n)), F.col(quoted(renamed[n]))).alias(n) if n in renamed
                else F.col(quoted(n))
                for n in schema.names
            )
        )
        size = sum(self._catalog.storage.size(path) for path in [*item.paths, *batch.paths])
        new = self._write(rows, keys, size, ends, True)
        self._put(replace(item.with_data(schema, new.paths, item.unique), derived=()).with_ends(ends))

    def _merge_buckets(self, table: Table, batch: Batch, order: list[str]) -> None:
        """Upsert into a table in buckets by the keys, all of which is written anew without shuffling it."""
        path = f"{self._root}/data/{uuid.uuid4().hex}"
        self._written.append(path)
        if not table.paths:
            rows, schema = batch.frame.repartition(table.buckets, *map(quoted, table.unique)), batch.schema
        else:
            schema = widened(table.schema, batch.schema)
            changes = batch.frame.withColumnRenamed(NODE_ID, unused("<new id>", batch.schema.names))
            rows = upserted(self._read(table), changes, table, order)
            given = F.col(quoted(changes.columns[batch.schema.names.index(NODE_ID)]))
            rows = rows.withColumn(NODE_ID, F.coalesce(F.col(quoted(NODE_ID)), given))
            rows = rows.select(*map(quoted, schema.names))
        write_bucketed(rows, path, table)
        self._put(replace(table, schema=schema, paths=(path,)))

    # ---- removing ----------------------------------------------------------

    def remove_nodes(self, wanted: DataFrame, labels: tuple[str, ...], keys: Sequence[str], detach: bool) -> bool:
        """Remove the nodes with the wanted keys, and their relationships; whether there are any."""
        batch = self._write(wanted.distinct())
        gone: list[DataFrame] = []
        for item in self._node_tables(labels, keys):
            if (ids := self._without(item, self._keys_as_stored(batch.frame, item, keys), keys, [NODE_ID])) is not None:
                gone.append(ids)
        if not gone:
            return False
        ids = union(gone).withColumnRenamed(NODE_ID, "id")
        for side in ("source", "target"):
            for item in [table for table in self.tables if table.rel_type]:
                ends = ids.select(F.col("id").alias(end_id(side)))
                if self._without(item, ends, [end_id(side)], []) is not None and not detach:
                    raise ValueError(f"nodes to remove have relationships of type {item.rel_type}: detach them")
        return True

    def remove_edges(
        self, wanted: DataFrame, rel_type: str, ends: tuple[NodePattern, NodePattern], identity: Sequence[str]
    ) -> bool:
        """Remove the relationships between the nodes that rows name; whether there are any."""
        found = False
        for item in [table for table in self.tables if table.rel_type == rel_type and table.has(identity)]:
            batch = self._write(wanted.distinct())
            rows, large = batch.frame, self._large(batch, item)
            pair: list[str] = []
            derived: dict[str, tuple[str, ...]] = {}
            for side, end in zip(("source", "target"), ends):
                rows = self._typed_ends(rows, side, end)
                names = [f"{side}.{name}" for name in end.keys.values()]
                origin = self._origin(end)
                if origin and (large or side in item.left_out) and self._follow(item, rows, side, origin):
                    # keys are shorter than identities, which can be told from them again
                    derived[side] = origin
                    pair += names
                    continue
                if origin:
                    # of a node that does not exist there are no relationships to remove
                    rows = rows.withColumn(end_id(side), derived_id(origin, f"{side}."))
                else:
                    rows = self._with_ids(rows, side, end)
                pair.append(end_id(side))
            pair += identity
            rows = self._keys_as_stored(rows.select(*map(quoted, pair)), item, identity)
            found |= self._without(item, rows, pair, [], large, derived) is not None
        return found

    def _follow(self, item: Table, rows: DataFrame, side: str, origin: tuple[str, ...]) -> bool:
        """Whether the identities of a side's nodes follow, in all of a table, from keys that it has beside them."""
        names = [f"{side}.{name}" for name in origin[1:]]
        for name in names:
            kind = rows.schema[name].dataType.simpleString()
            if name not in item.schema.names or kind not in _PLAIN or item.schema[name].dataType.simpleString() != kind:
                return False
        if side in item.left_out:
            return item.left_out[side] == origin
        same = F.col(quoted(end_id(side))) == derived_id(origin, f"{side}.")
        return self._read(item).where(~F.coalesce(same, F.lit(False))).isEmpty()

    def clear(self, wanted: DataFrame, labels: tuple[str, ...], keys: Sequence[str], properties: Sequence[str]) -> bool:
        """Set properties of the nodes with the wanted keys to NULL; whether a table has such."""
        changed = False
        for item in self._node_tables(labels, keys):
            there = [name for name in item.schema.names if name in properties]
            if there:
                rows = self._keys_as_stored(wanted, item, keys)
                for key in keys:
                    rows = rows.where(F.col(quoted(key)).isNotNull())
                rows = rows.distinct()
                empty = [F.lit(None).cast(item.schema[name].dataType).alias(name) for name in there]
                batch = self._write(rows.select(*map(quoted, keys), *empty))
                self._merge(Table(labels=item.labels), batch, keys, True, [item], add=False)
                changed = True
        return changed

    def _typed_ends(self, rows: DataFrame, side: str, end: NodePattern) -> DataFrame:
        names = list(end.keys.values())
        types = _key_types(self._node_tables(end.labels, names), names)
        return self._typed(rows, [f"{side}.{n}" for n in names], {f"{side}.{n}": kind for n, kind in types.items()})

    def _keys_as_stored(self, rows: DataFrame, item: Table, keys: Sequence[str]) -> DataFrame:
        return self._typed(rows, keys, {key: item.schema[key].dataType for key in keys})

    def _without(
        self, item: Table, wanted: DataFrame, keys: Sequence[str], returned: Sequence[str], large: bool = False,
        derived: Mapping[str, tuple[str, ...]] | None = None,
    ) -> DataFrame | None:
        """Remove a table's rows with the wanted keys; these rows' ``returned`` columns, None if there are none.

        A semi join finds the rows and their folders, and only these are written again; if
        ``large``, and nothing is returned, the whole table is, by one join, without the identities
        of ``derived`` sides, which follow from keys. The table is on the left, the side that
        adaptive execution splits.
        """
        if large and not returned and _meet(stored := self._read(item), wanted, keys):
            derived = derived or {}
            rows = stored.drop(*map(end_id, derived)).join(wanted, list(keys), "left_anti")
            for side, origin in derived.items():
                rows = rows.withColumn(end_id(side), derived_id(origin, f"{side}."))
            rows = rows.select(*map(quoted, item.schema.names))
            size = sum(self._catalog.storage.size(path) for path in item.paths)
            new = self._write(rows, item.unique, size, item.left_out)
            self._put(item.with_data(item.schema, new.paths, item.unique))
            return new.frame.select()
        name = unused("__folder", [*keys, *returned])
        folder = F.regexp_extract(F.col("_metadata.file_path"), _FOLDER, 1)
        columns = dict.fromkeys([*keys, *returned])
        plain = item.with_data(item.schema, item.paths, item.unique)
        place = self._read(plain).select(*map(quoted, columns), folder.alias(name))
        hits = self._write(place.join(wanted, list(keys), "left_semi").select(*map(quoted, returned), quoted(name))).frame
        folders = {row[0] for row in hits.select(name).distinct().collect()}
        if not folders:
            return None
        hit = [path for path in item.paths if path.split("/data/")[-1] in folders]
        kept = [path for path in item.paths if path not in hit]
        rows = self._read(item.with_data(item.schema, hit, ())).join(wanted, list(keys), "left_anti")
        size = sum(self._catalog.storage.size(path) for path in hit)
        new = self._write(rows.select(*map(quoted, item.schema.names)), item.unique, size, item.left_out)
        self._put(item.with_data(item.schema, [*kept, *new.paths], item.unique))
        return hits.drop(name)

    def _add(self, table: Table, batch: Batch, keys: Sequence[str], origin: tuple[str, ...] = ()) -> None:
        """Add a batch's folders to a table. ``keys``: of which no row shares all with another;
        ``origin``: what its nodes' identities follow from."""
        current = self._current(table)
        unique = keys if not current.paths or set(current.unique) == set(keys) else ()
        origin = origin if not current.paths or current.derived == origin else ()
        schema = widened(current.schema, batch.schema)
        mixed = bool(current.paths) and (current.mixed or current.ends != batch.ends)
        added = replace(current.with_data(schema, [*current.paths, *batch.paths], unique), derived=origin)
        self._put(added.with_ends({**current.ends, **batch.ends}, mixed))

    def _current(self, table: Table) -> Table:
        return next((t for t in self.tables if t.identity == table.identity), table)

    def _put(self, table: Table) -> None:
        self.tables = [t for t in self.tables if t.identity != table.identity] + [table]

    def compact(self) -> None:
        """Small folders of each table into as few as their size asks for."""
        size = self._catalog.storage.size
        for table in self.tables:
            small = {path: found for path in table.paths if (found := size(path)) < self.folder_bytes}
            if len(small) < 2:
                continue
            rows = self._read(table.with_data(table.schema, small, ()))
            keys = table.unique or table.schema.names[:1]
            new = self._write(rows, keys, sum(small.values()), table.left_out)
            kept = [path for path in table.paths if path not in small]
            self._put(table.with_data(table.schema, [*kept, *new.paths], table.unique))

    def _size(self, batch: Batch) -> int:
        return sum(self._catalog.storage.size(path) for path in batch.paths)

    def _write(
        self, frame: DataFrame, keys: Sequence[str] = (), size: int = 0,
        ends: Mapping[str, tuple[str, ...]] | None = None, joined: bool = False,
    ) -> Batch:
        """Rows in a folder, or in several by the hash of ``keys`` if ``size`` bytes are many.

        Identities of ``ends`` are left out, as they follow from keys. Rows that a full join by
        ``keys`` has ``joined`` are not shuffled again to be dealt to folders.
        """
        path = f"{self._root}/data/{uuid.uuid4().hex}"
        self._written.append(path)
        ends = ends or {}
        left_out = [end_id(side) for side in ends]
        folders = -(-size // self.folder_bytes) if keys else 1
        if folders > 1:
            name = unused("bucket", frame.columns)
            values = [F.col(quoted(key)) for key in keys]
            if joined:
                dealt = frame.withColumn(name, _joined_folder(frame, values, folders)).drop(*left_out)
            else:
                bucket = F.pmod(F.xxhash64(*values), F.lit(folders))
                dealt = frame.withColumn(name, bucket).drop(*left_out).repartition(name)
            dealt.write.partitionBy(name).parquet(path)
            found = sorted(self._catalog.storage.names(path))
            paths = tuple(f"{path}/{item}" for item in found if item.startswith(f"{name}="))
        else:
            frame.drop(*left_out).write.parquet(path)
            paths = (path,)
        stored = Table(schema=frame.schema, paths=paths).with_ends(ends)
        return Batch(self._read(stored), frame.schema, paths, ends)

    def _write_sides(self, frames: dict[str, DataFrame]) -> dict[str, Batch]:
        """Several frames in one job, a folder each."""
        if len(frames) == 1:
            return {side: self._write(frame) for side, frame in frames.items()}
        path = f"{self._root}/data/{uuid.uuid4().hex}"
        self._written.append(path)
        name = unused("bucket", [item for frame in frames.values() for item in frame.columns])
        tagged = [frame.withColumn(name, F.lit(n)) for n, frame in enumerate(frames.values())]
        union(tagged).write.partitionBy(name).parquet(path)
        there = set(self._catalog.storage.names(path))
        out = {}
        for n, (side, frame) in enumerate(frames.items()):
            paths = (f"{path}/{name}={n}",) if f"{name}={n}" in there else ()
            stored = Table(schema=frame.schema, paths=paths)
            rows = self._read(stored) if paths else frame.limit(0)
            out[side] = Batch(rows, frame.schema, paths)
        return out


def _key_id(keys: Sequence[str]) -> Column:
    """An identity that every row of a write with these keys gets, and no other write's."""
    parts = [F.to_json(F.struct(*(F.col(quoted(key)) for key in keys)))]
    return F.unhex(F.md5(F.concat(F.lit(uuid.uuid4().hex), *parts)))


def _meet(table: DataFrame, batch: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a table has the keys of some of a batch's first rows, looked up without a shuffle of the table."""
    names = [quoted(key) for key in keys]
    some = batch.select(*names).limit(1000)
    return not table.select(*names).join(F.broadcast(some), list(keys), "left_semi").isEmpty()


def derived_id(origin: tuple[str, ...], prefix: str = "") -> Column:
    """The identity that follows from keys: of two nodes it is the same only if all their keys are."""
    seed, *names = origin
    texts = [F.col(quoted(f"{prefix}{name}")).cast("string") for name in names]
    parts = [part for text in texts for part in (F.octet_length(text).cast("string"), F.lit(":"), text)]
    return F.unhex(F.md5(F.concat(F.lit(seed), *parts)))


def _alike(item: Table, batch: Batch) -> dict[str, tuple[str, ...]]:
    """The sides whose identities follow from the same in all rows of a table and of a batch."""
    return {side: origin for side, origin in item.left_out.items() if batch.ends.get(side) == origin}


def _by_keys(keys: Sequence[str], ends: Mapping[str, tuple[str, ...]]) -> list[str]:
    """``keys`` with the nodes' keys, which are shorter, for identities that follow from them."""
    names = {end_id(side): [f"{side}.{name}" for name in origin[1:]] for side, origin in ends.items()}
    return [name for key in keys for name in names.get(key, [key])]


def _joined_folder(frame: DataFrame, keys: Sequence[Column], folders: int) -> Column:
    """The folder of a row that a join by ``keys`` has shuffled.

    A partition of that shuffle goes to one folder or to neighbours, so a task, which has
    neighbouring partitions, writes to few. Were rows shuffled otherwise, there would be more files.
    """
    conf = frame.sparkSession.conf
    number = int(conf.get("spark.sql.shuffle.partitions"))
    if all(conf.get(f"spark.sql.adaptive.{name}enabled") == "true" for name in ("", "coalescePartitions.")):
        number = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or number)
    parts = 1 << 16
    place = F.pmod(F.hash(*keys), F.lit(number)) + F.pmod(F.xxhash64(*keys), F.lit(parts)) / F.lit(parts)
    return F.floor(place * F.lit(folders) / F.lit(number))


def _apart(one: NodePattern, two: NodePattern, frames: dict[str, DataFrame]) -> bool:
    """Whether no node of one end can be meant by the other, and one write can hold both."""
    if set(one.labels) <= set(two.labels) or set(two.labels) <= set(one.labels):
        return False
    kinds: dict[str, str] = {}
    for frame in frames.values():
        for item in frame.schema:
            if kinds.setdefault(item.name, item.dataType.simpleString()) != item.dataType.simpleString():
                return False
    return True


def _key_types(tables: Sequence[Table], keys: Iterable[str]) -> dict[str, DataType]:
    """The type each key is stored in, which must be one."""
    types: dict[str, DataType] = {}
    for table in tables:
        for key in keys:
            kind = table.schema[key].dataType
            if types.setdefault(key, kind).simpleString() != kind.simpleString():
                raise ValueError(f"key '{key}' is stored in several types")
    return types
