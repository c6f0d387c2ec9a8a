"""What the operators share: the folder all executors see, staged tables, words."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

#: What separates words, as bytes.split() does: \x20 and \x09-\x0D.
SPACES = " \t\n\r\x0b\x0c"
#: Texts, and bytes of text, that a task works on together.
PORTION_ROWS, PORTION_BYTES = 500, 2_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a new local one where it is unset and the master local."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


class Staged:
    """A table written to the shared folder. It cuts lineage and survives lost executors.

    While it is written, Python gets few rows at a time, as any of them may be a long text. With ``once`` Spark
    deletes the shuffle files as soon as the table is written, where it knows the setting (4.1).
    """

    batch_rows = "1000"

    def __init__(self, frame: DataFrame, name: str, once: bool = False):
        self.spark, self.path, self.schema = frame.sparkSession, new_path(frame.sparkSession, name), frame.schema
        settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": self.batch_rows}
        if once:
            settings["spark.sql.classic.shuffleDependency.fileCleanup.enabled"] = "true"
        before = {setting: self.spark.conf.get(setting, None) for setting in settings}
        for setting, value in settings.items():
            self.spark.conf.set(setting, value)
        try:
            frame.write.parquet(self.path)
        finally:
            for setting, value in before.items():
                self.spark.conf.unset(setting) if value is None else self.spark.conf.set(setting, value)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def discard(self) -> None:
        """Delete the files, once nothing lazy reads them any more."""
        remove(self.spark, self.path)


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def let_go(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of plans that nothing refers to any more.

    It does so when the driver's garbage is collected, which may be long after.
    """
    gc.collect()
    spark._jvm.System.gc()


def store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path and the path in it, for streams that tasks read or write."""
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file:///" + path[len("file:/") :].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


def part_count(spark: SparkSession, rows: int, per_part: int) -> int:
    """So many partitions that each has about ``per_part`` rows at most."""
    return max(1, -(-rows // per_part))


def portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most so many rows and about so many bytes of text, or one text that is longer."""
    ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = int(np.searchsorted(ends, before + PORTION_BYTES, side="right"))
        end = min(max(end, start + 1), start + PORTION_ROWS)
        yield batch.slice(start, end - start)
        start = end
