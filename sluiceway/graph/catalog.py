"""The list of a graph's tables, one immutable version per write.

A version is a small file of JSON that names Parquet folders. Folders are
written first and never changed; a write shows once its version is there. Of
two writers that start from the same version one succeeds, and the other fails.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from sluiceway.graph.model import Table
from sluiceway.storage import Storage


class VersionTaken(RuntimeError):
    """Another write has published the version this one would be."""


class Catalog:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self._folder = f"{root}/versions"
        self.storage = Storage(spark, root)

    def _file(self, version: int) -> str:
        return f"{self._folder}/{version:020d}.json"

    def _hint(self) -> str:
        return f"{self._folder}/newest"

    def versions(self) -> list[int]:
        names = self.storage.names(self._folder)
        return sorted(int(name[:-5]) for name in names if name[:-5].isdigit())

    def newest(self) -> int:
        """The newest version's number; 0 for a new graph.

        A pointer says where to look first. It may lag behind, so the versions
        after it are asked for one by one; without it the names are listed.
        """
        try:
            found = int(self.storage.read(self._hint()))
        except Exception:
            found = 0
        if not found or not self.storage.exists(self._file(found)):
            found = max(self.versions(), default=0)
        while self.storage.exists(self._file(found + 1)):
            found += 1
        return found

    def load(self, version: int | None = None) -> tuple[int, list[Table]]:
        """A version's number, the newest if none is given, and its tables."""
        version = self.newest() if version is None else version
        if not version:
            return 0, []
        text = self.storage.read(self._file(version))
        return version, [Table.from_dict(item) for item in json.loads(text)]

    def publish(self, version: int, tables: list[Table]) -> None:
        """Make ``tables`` the graph's state; fails if ``version`` exists already."""
        text = json.dumps([table.to_dict() for table in tables])
        try:
            self.storage.write_new(self._file(version), text)
        except FileExistsError as error:
            raise VersionTaken(f"another writer took version {version}; write again") from error
        self.storage.write(self._hint(), str(version))

    def forget(self, version: int) -> None:
        self.storage.remove(self._file(version))
