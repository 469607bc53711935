"""Batch tasks and their results: errors are values of a row, never failures of a Spark task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions import names
from folioforge.operators.textlayer import last_wins


def tasks(files: DataFrame, destination: str, save_pictures: bool = False, only_pictures: bool = False, **options: object) -> DataFrame:
    """rel_path, source, target, pictures, only_pictures and the options, for a listing with path and rel_path."""
    return files.select(
        "rel_path",
        F.col("path").alias("source"),
        names.joined(destination.rstrip("/"), F.col("rel_path")).alias("target"),
        names.pictures_dir(F.col("rel_path"), destination, F.lit(save_pictures or only_pictures)).alias("pictures"),
        F.lit(only_pictures).alias("only_pictures"),
        *[F.lit(v).alias(k) for k, v in options.items()],
    )


def run_tasks(todo: DataFrame, work: Callable[[dict], None], partitions: int | None = None) -> DataFrame:
    """rel_path, file_name, error (null: success) of work(row) for each row, in parallel over partitions."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                try:
                    work(row)
                    error = None
                except Exception as e:  # the row's result
                    error = str(e) or type(e).__name__
                out.append((row["rel_path"], row["rel_path"].rpartition("/")[2], error))
            yield pd.DataFrame(out, columns=["rel_path", "file_name", "error"])

    spread = todo.repartition(partitions or max(1, todo.sparkSession.sparkContext.defaultParallelism))
    return spread.mapInPandas(run, "rel_path string, file_name string, error string")


def by_name(results: DataFrame, order: str = "rel_path") -> DataFrame:
    """file_name, error with the last row of each name: files of one name in several folders share a result."""
    return last_wins(results, "file_name", "error", order)


def summary(results: DataFrame) -> DataFrame:
    return results.agg(F.count("*").alias("total"), F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("failed"))
