"""Directory listing as a Python data source: sees every name, also those with a leading `_` or `.`.

    register(spark)
    spark.read.format("dirlist").option("recursive", "true").load(root)

Spark's own file sources hide such names. A partition is one directory below the root, so scans spread out;
folders must be reachable from the executors under the same path.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "root string, dir string, name string, path string, rel_path string, is_file boolean, is_dir boolean, length long, mtime timestamp"


class Folder(InputPartition):
    def __init__(self, path: str, deep: bool):
        self.path, self.deep = path, deep


class DirListReader(DataSourceReader):
    def __init__(self, root: str, recursive: bool, missing_ok: bool):
        self.root, self.recursive, self.missing_ok = root.rstrip("/") or "/", recursive, missing_ok

    def partitions(self) -> list[Folder]:
        if not os.path.isdir(self.root):
            if self.missing_ok:
                return [Folder("", False)]
            raise NotADirectoryError(self.root)
        below = []
        if self.recursive:
            with os.scandir(self.root) as entries:
                below = sorted(e.path for e in entries if e.is_dir() and not e.is_symlink())
        return [Folder(self.root, False), *(Folder(p, True) for p in below)]

    def read(self, partition: Folder) -> Iterator[tuple]:
        todo = [partition.path] if partition.path else []
        while todo:
            folder = todo.pop()
            with os.scandir(folder) as entries:
                for e in entries:
                    try:
                        info = e.stat()
                    except OSError:  # gone meanwhile, or a link to nothing
                        continue
                    rel = os.path.relpath(e.path, self.root)
                    yield (self.root, os.path.dirname(rel), e.name, e.path, rel, e.is_file(), e.is_dir(), info.st_size, datetime.fromtimestamp(info.st_mtime, timezone.utc))
                    if partition.deep and e.is_dir() and not e.is_symlink():
                        todo.append(e.path)


class DirListSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dirlist"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DirListReader:
        true = lambda k: self.options.get(k, "false").lower() == "true"
        return DirListReader(self.options["path"], true("recursive"), true("missingOk"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DirListSource)


def listing(spark: SparkSession, root: str, recursive: bool = False, missing_ok: bool = False) -> DataFrame:
    register(spark)
    return spark.read.format("dirlist").options(recursive=str(recursive).lower(), missingOk=str(missing_ok).lower()).load(root)


def children(spark: SparkSession, root: str) -> DataFrame:
    """dir, name of the files in each folder right below root whose name doesn't begin with a dot."""
    own = listing(spark, root, recursive=True).where("is_file and dir != '' and not contains(dir, '/') and not startswith(dir, '.')")
    return own.select("dir", "name", "path")
