"""Choosing image files for assembly into documents, and skipping what exists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions import names

# Defaults of the choice.
PREFIXES, SUFFIXES, EXTENSIONS = ("_",), ("-4x",), ("jpg", "jpeg")


def assembly_filter(files: DataFrame, prefixes: Sequence[str] = PREFIXES, suffixes: Sequence[str] = SUFFIXES, extensions: Sequence[str] = EXTENSIONS) -> DataFrame:
    """Files whose extension (any case), a prefix of the name and a suffix of the stem match; an empty list matches none."""
    n = F.col("name")
    some = lambda tests: F.lit(False) if not tests else F.array_max(F.array(*tests))
    chosen = F.lit(False) if not extensions else names.extension(n).isin([e.lower() for e in extensions])
    return files.where(chosen & some([F.startswith(n, F.lit(p)) for p in prefixes]) & some([F.endswith(names.stem(n), F.lit(s)) for s in suffixes]))


def manifest(files: DataFrame) -> DataFrame:
    """dir, pdf_name, images: each directory's images in name order."""
    return files.groupBy("dir").agg(F.array_sort(F.collect_list("name")).alias("images")).select("dir", F.concat("dir", F.lit(".pdf")).alias("pdf_name"), "images")


def todo(wanted: DataFrame, existing: DataFrame, column: str = "pdf_name") -> DataFrame:
    """Rows of wanted whose output isn't there yet."""
    return wanted.join(existing.select(column).distinct(), column, "left_anti")
