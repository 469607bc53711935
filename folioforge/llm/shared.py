"""Helpers that several training-data operators use: shared storage, checked broadcasts, fixed bitmaps."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Most rows of a side that is broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 300_000
#: Bytes of the batches in which Spark hands rows to Python while written() runs, and its setting's name.
ARROW_BYTES, ARROW_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's URI below spark.checkpoint.dir, which every executor sees.

    Only where that setting is absent and the master is local (tests, one machine), a temporary folder is set and used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("folioforge.shared.dir", None)
        if not root:
            master = spark.sparkContext.master
            if master.partition("[")[0] != "local":
                raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
            root = "file://" + tempfile.mkdtemp(prefix="folioforge-")
            spark.conf.set("folioforge.shared.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark's batches for Python are of ARROW_BYTES: executor and worker each hold a whole one, 64 MB by default."""
    before = spark.conf.get(ARROW_SETTING, None)
    spark.conf.set(ARROW_SETTING, str(ARROW_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(ARROW_SETTING) if before is None else spark.conf.set(ARROW_SETTING, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes the folders of tables that written() gave and that nothing will read again."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def swept(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished plans; it does so only when the driver's garbage is collected."""
    gc.collect()
    spark._jvm.System.gc()


def checked(side: DataFrame, rows: int | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """side with a broadcast hint if it has few rows (counted, unless rows is given), else unchanged."""
    n = side.limit(most + 1).count() if rows is None else rows
    return F.broadcast(side) if n <= most else side


def ascii_lower(text: Column) -> Column:
    """text with A-Z alone lower-cased; null becomes empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    n = F.size(F.split(trimmed, SPACE_RUN)).cast("long")
    return F.when(text.isNull() | (trimmed == ""), F.lit(0).cast("long")).otherwise(n)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return lambda _: 0


def given_back() -> None:
    """Lets freed memory go back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    _trim()(0)


def batches(it: Iterator[pa.RecordBatch], most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded bytes (single longer rows pass alone).

    At the end, freed memory goes back to the system: workers are reused by other operators' tasks.
    """
    for b in it:
        parts = max(1, -(-b.nbytes // most_bytes))
        step = max(1, b.num_rows // parts)
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)
    given_back()
