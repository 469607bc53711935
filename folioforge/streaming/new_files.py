"""New files as a stream: an extension that keeps inventories and batches up to date.

The source remembers the newest modification time and name that it has given out; each trigger lists the tree
and gives out what is later.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

SCHEMA = "dir string, name string, path string, rel_path string, length long, mtime double"


class NewFilesReader(SimpleDataSourceStreamReader):
    def __init__(self, root: str):
        self.root = root.rstrip("/") or "/"

    def initialOffset(self) -> dict:
        return {"mtime": 0.0, "rel_path": ""}

    def _files(self) -> list[tuple]:
        out = []
        for folder, _, names in os.walk(self.root):
            for name in names:
                path = os.path.join(folder, name)
                try:
                    info = os.stat(path)
                except OSError:
                    continue
                rel = os.path.relpath(path, self.root)
                out.append((os.path.dirname(rel), name, path, rel, info.st_size, info.st_mtime))
        return sorted(out, key=lambda r: (r[5], r[3]))

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows = [r for r in self._files() if (r[5], r[3]) > (start["mtime"], start["rel_path"])]
        end = {"mtime": rows[-1][5], "rel_path": rows[-1][3]} if rows else start
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        low, high = (start["mtime"], start["rel_path"]), (end["mtime"], end["rel_path"])
        return iter([r for r in self._files() if low < (r[5], r[3]) <= high])

    def commit(self, end: dict) -> None:
        pass


class NewFilesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "newfiles"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema: StructType) -> NewFilesReader:
        return NewFilesReader(self.options["path"])


def new_files(spark: SparkSession, root: str) -> DataFrame:
    spark.dataSource.register(NewFilesSource)
    return spark.readStream.format("newfiles").load(root)
