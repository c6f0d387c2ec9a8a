"""Paths and small files by way of Hadoop's file systems, on the driver."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


class Storage:
    """The file system that a folder is in."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._system = self._path(folder).getFileSystem(self._conf)
        # Hadoop's local file system looks, then creates: two writers may both succeed.
        self._local = self._system.getUri().getScheme() == "file"

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """The names in a folder; none if there is no such folder."""
        if not self.exists(folder):
            return []
        return [item.getPath().getName() for item in self._system.listStatus(self._path(folder))]

    def age_seconds(self, path: str) -> float:
        changed = self._system.getFileStatus(self._path(path)).getModificationTime()
        return (self._jvm.java.lang.System.currentTimeMillis() - changed) / 1000

    def size(self, path: str) -> int:
        return self._system.getContentSummary(self._path(path)).getLength()

    def read(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Write a small file, over one that is there."""
        stream = self._system.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> None:
        """Make a small file appear whole; FileExistsError if it is there already.

        One of several writers succeeds on local disks, on HDFS, and wherever
        a rename without overwriting is atomic; object stores mostly lack that.
        """
        folder, _, name = path.rpartition("/")
        draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.write(draft, text)
        try:
            if self._local:
                place = [self._path(item).toUri().getPath() for item in (draft, path)]
                os.link(*place)
            else:
                files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                    self._system.getUri(), self._conf
                )
                options = SparkContext._gateway.new_array(
                    self._jvm.org.apache.hadoop.fs.Options.Rename, 0
                )
                files.rename(self._path(draft), self._path(path), options)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            raise FileExistsError(path) from error
        finally:
            self.remove(draft)

    def remove(self, path: str) -> None:
        self._system.delete(self._path(path), True)


def staging_path(spark: SparkSession) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``, which all executors share.

    Where that is unset and the master local, a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="sluiceway-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/staged-{uuid.uuid4().hex}"


class Staged:
    """Rows written to the shared folder, read back as often as needed, removed at the end of the block."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._paths = spark, []

    def __enter__(self) -> "Staged":
        return self

    def __exit__(self, *_) -> None:
        for path in self._paths:
            Storage(self._spark, path).remove(path)

    def path(self) -> str:
        self._paths.append(staging_path(self._spark))
        return self._paths[-1]

    def rows(self, frame: DataFrame) -> DataFrame:
        path = self.path()
        frame.write.parquet(path)
        return self._spark.read.schema(frame.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, without dots, doubled slashes and links of local disks."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        place = system.makeQualified(place)
        try:
            place = system.resolvePath(place)  # what a mounted path stands for
        except Py4JJavaError:
            pass  # there is nothing yet
    except Py4JJavaError:
        pass  # no such file system here; the text is compared
    uri = place.toUri().normalize()
    if uri.getScheme() == "file":
        return "file://" + os.path.realpath(uri.getPath())
    return f"{uri.getScheme() or ''}://{uri.getAuthority() or ''}{uri.getPath().rstrip('/') or '/'}"
