"""The list of queries, and the folder they may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluiceway import Source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL for the same rows."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


def parquet(sf_dir: str, table: str, **steps) -> Source:
    """A source over one of the test tables."""
    return Source("parquet", {"path": f"{sf_dir}/{table}.parquet"}, **steps)


def scratch(spark: SparkSession) -> str:
    """A new path in the folder all executors share, as the cluster names it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="sluiceway-")
        spark.conf.set("spark.checkpoint.dir", shared)
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/sluiceway-{uuid.uuid4().hex}"
