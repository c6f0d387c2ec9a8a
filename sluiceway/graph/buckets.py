"""Tables in Spark's buckets, which joins on the bucketed columns do not shuffle.

Spark takes the buckets of files from its catalog, so a folder is declared there, under a name
that follows from its path, when it is opened; the graph's own list stays what says which
folders there are. Files are plain Parquet to all who do not ask for buckets.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.functions.columns import quoted
from sluiceway.graph.model import Table
from sluiceway.operators.merge import merged_columns


def _name(path: str) -> str:
    return f"sluiceway_{hashlib.md5(path.encode()).hexdigest()}"


def open_bucketed(spark: SparkSession, table: Table) -> DataFrame:
    """A table whose one folder is in buckets by its ``unique`` columns."""
    (path,) = table.paths
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{quoted(item.name)} {item.dataType.simpleString()}" for item in table.schema)
        keys = ", ".join(map(quoted, table.unique))
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {table.buckets} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)


def write_bucketed(frame: DataFrame, path: str, table: Table) -> None:
    """Rows in ``table``'s buckets: in the tasks they are in where those are the buckets already."""
    name = _name(path)
    writer = frame.write.format("parquet").option("path", path)
    first, *others = table.unique
    writer.bucketBy(table.buckets, first, *others).sortBy(first, *others).saveAsTable(name)


def upserted(stored: DataFrame, batch: DataFrame, table: Table, order: list[str]) -> DataFrame:
    """All rows of both by the bucketed keys: stored ones with the batch's columns set, and new ones.

    The batch, with one row per key, is dealt to the buckets; the stored side stays where it is. A
    full join tells matched, stored and new rows in one pass.
    """
    keys = list(table.unique)
    dealt = batch.repartition(table.buckets, *map(quoted, keys))
    return merged_columns(stored, dealt, keys, order, "full")
